"""Month and year columns with explicit value lists."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Month = tuple[int, int]


def months_between(first: date, last: date) -> list[Month]:
    """(year, month) pairs from ``first`` to ``last``, both included."""
    total = (last.year - first.year) * 12 + last.month - first.month
    start = first.year * 12 + first.month - 1
    return [((start + i) // 12, (start + i) % 12 + 1) for i in range(total + 1)]


def label(month: Month) -> str:
    return f"{month[0]}/{month[1]}"


def pivot_months(df: DataFrame, keys: list[str], months: list[Month],
                 value: str = "amount") -> DataFrame:
    """One 0-filled column per month, in time order.

    Periods that are not listed are summed in the column ``other``, so a row
    always adds up.
    """
    def cell(test: str, name: str) -> Column:
        total = f"sum({value}) FILTER (WHERE {test})"
        return F.expr(f"coalesce({total}, cast(0 AS decimal(38,2))) AS `{name}`")

    period = "xyear * 100 + xper"
    listed = ", ".join(str(y * 100 + p) for y, p in months)
    return df.groupBy(*keys).agg(
        *[cell(f"{period} = {y * 100 + p}", label((y, p))) for y, p in months],
        cell(f"{period} NOT IN ({listed})", "other"))


def show_months(df: DataFrame, keys: list[str], last: date) -> DataFrame:
    """Rows of ``keys``, xyear, xper and amount as one column per month.

    Lists every month from the first in the data to ``last`` and the opening
    periods that have rows, so ``other`` is left with nothing.  Only the
    distinct periods are read ahead, twelve or thirteen a year.
    """
    found = [(r.xyear, r.xper) for r in df.select("xyear", "xper").distinct().collect()]
    monthly = [p for p in found if p[1] > 0]
    first = date(*min(monthly), 1) if monthly else last
    return pivot_months(df, keys, sorted({*months_between(first, last), *found}))


def month_columns(months: list[Month]) -> list[str]:
    """Value columns of ``pivot_months``."""
    return [*[label(x) for x in months], "other"]


def year_column(year: int) -> str:
    return f"y{year}"


def pivot_years(df: DataFrame, keys: list[str], years: list[int],
                value: str = "amount") -> DataFrame:
    """One column per statement year; a line without a value stays NULL."""
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("year") == y, F.col(value))).alias(year_column(y)) for y in years
    ])

