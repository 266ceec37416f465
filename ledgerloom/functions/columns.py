"""Column expressions. All of them stay in the JVM; there is no UDF."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def signed_qty() -> Column:
    """Quantity with its direction: receipts add, issues subtract."""
    return F.col("xqty") * F.col("xsign")


def signed_value() -> Column:
    return F.col("xval") * F.col("xsign")


def doc_is(prefix: str, col: str = "xdocnum") -> Column:
    """Document type test; a prefix test reaches the file scan."""
    return F.col(col).startswith(prefix)


def doc_has(text: str, col: str = "xdocnum") -> Column:
    return F.col(col).contains(text)


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def days_before(value: date | str, n: int) -> Column:
    return F.date_sub(day(value), n)


def sum_when(cond: Column, value: Column) -> Column:
    """Conditional total, 0 when no row qualifies."""
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0).cast("decimal(38,2)"))


def ratio(num: Column, den: Column) -> Column:
    """Quotient as double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


RATE_DIGITS = 10
RATE = f"decimal(21,{RATE_DIGITS})"


def rate(num: Column, den: Column) -> Column:
    """Unit rate as a decimal of ten digits, rounded half up; NULL on a zero divisor.

    A rate is multiplied and summed again later, so it must not be a double (a
    sum of doubles depends on the order in which the rows arrive) and must not
    be rounded to what a report shows.
    """
    exact = F.try_divide(num.cast("decimal(26,10)"), den.cast("decimal(16,2)"))
    return F.round(exact, RATE_DIGITS).cast(RATE)


def at_rate(quantity: Column, unit_rate: Column) -> Column:
    """Value of a quantity at a unit rate, exactly."""
    return quantity.cast("decimal(16,2)") * unit_rate.cast(RATE)


def month_label(year: str = "xyear", period: str = "xper") -> Column:
    return F.concat_ws("/", F.col(year).cast("string"), F.col(period).cast("string"))


def literal(value) -> str:
    """SQL text of a constant; a list is an array, a dict a struct."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    if isinstance(value, dict):
        fields = ", ".join(f"{literal(name)}, {literal(v)}" for name, v in value.items())
        return f"named_struct({fields})"
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(literal(v) for v in value)})"
    return str(value)


def lookup(key: Column, mapping: Mapping) -> Column:
    """Constant dictionary lookup; NULL for an unknown key."""
    pairs = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in mapping.items())
    return F.try_element_at(F.expr(f"map({pairs})"), key)


def seeded_hash(seed: int, *cols: Column) -> Column:
    """32 uniform bits from md5, the same in every engine and on every retry."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def newest(order: Iterable[str], payload: Iterable[str]) -> Column:
    """Whole newest row of a group as a struct.

    ``max`` of a struct aggregates on the map side, so a group that holds most
    of the table is reduced before the shuffle; a ranking window would move all
    of it into one task.  ``order`` must be a total order.
    """
    order = list(order)
    return F.max(F.struct(*order, *[c for c in payload if c not in order]))


def constant_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """In-code dimension as a local relation, whose size the planner knows."""
    names = [f.strip().split()[0] for f in schema.split(",")]
    types = [f.strip().split()[1] for f in schema.split(",")]

    body = ", ".join(
        "(" + ", ".join(f"CAST({literal(v)} AS {t})" for v, t in zip(row, types)) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
