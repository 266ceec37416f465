"""Item, unit and group profit.

A document that repeats an item joins each of its movements with each of its
lines.  The sums over those pairs follow from per-side sums and counts, so both
sides are first aggregated by (unit, document, item): the totals are those of
the full join, and the pairs themselves are never formed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import day, doc_has, ratio, signed_qty, signed_value
from ledgerloom.functions.totals import with_totals
from ledgerloom.model import CENTRAL, Model
from ledgerloom.operators.ledger import gl_entries
from ledgerloom.operators.stock import KEY

DOC_KEY = ["zid", "xdocnum", "xitem"]
TOTAL_LABEL = "Total_Item_Profit"


def _moved(m: Model, text: str, a: date, b: date) -> DataFrame:
    """Movements of a document type between two days, per document and item."""
    return (m.imtrn.filter(doc_has(text) & F.col("xdate").between(day(a), day(b)))
            .groupBy(*DOC_KEY)
            .agg(F.sum(signed_qty()).alias("qty"), F.sum(signed_value()).alias("value"),
                 F.sum("xqty").alias("raw_qty"), F.count(F.lit(1)).alias("moves")))


def _of_window(m: Model, lines: DataFrame, text: str, a: date, b: date) -> DataFrame:
    """Lines of the documents that moved between two days; the others are never grouped."""
    documents = m.imtrn.filter(doc_has(text) & F.col("xdate").between(day(a), day(b)))
    return lines.join(documents.select("zid", "xdocnum").distinct(), ["zid", "xdocnum"], "left_semi")


def _paired(m: Model, lines: DataFrame, headers: DataFrame, text: str, a: date, b: date) -> DataFrame:
    return (_moved(m, text, a, b).join(lines, DOC_KEY)
            .join(headers.select("zid", "xdocnum"), ["zid", "xdocnum"], "left_semi"))


def _listed(m: Model, rows: DataFrame) -> DataFrame:
    return rows.join(m.caitem.select(*KEY), KEY, "left_semi")


def _times(total: str, count: str):
    return (F.col(total) * F.col(count)).cast("decimal(38,2)")


def _sales(m: Model, a: date, b: date) -> DataFrame:
    lines = (_of_window(m, m.opodt.withColumnRenamed("xordernum", "xdocnum"), "CO--", a, b).groupBy(*DOC_KEY)
             .agg(F.count(F.lit(1)).alias("lines"), F.sum("xlineamt").alias("amount"),
                  F.sum(F.col("xdtwotax") - F.col("xdtdisc")).alias("net")))
    headers = m.opord.withColumnRenamed("xordernum", "xdocnum")
    return _paired(m, lines, headers, "CO--", a, b).select(
        *DOC_KEY, (F.col("moves") * F.col("lines")).alias("n_pairs"),
        _times("qty", "lines").alias("qty"), _times("value", "lines").alias("totalvalue"),
        _times("amount", "moves").alias("xlineamt"), _times("net", "moves").alias("xdtwotax"))


def _transfers(m: Model, a: date, b: date) -> DataFrame:
    lines = (_of_window(m, m.imtdt.withColumnRenamed("ximtor", "xdocnum"), "TO--", a, b).groupBy(*DOC_KEY)
             .agg(F.count(F.lit(1)).alias("lines"), F.sum("xdtwotax").alias("amount")))
    headers = m.imtor.withColumnRenamed("ximtor", "xdocnum")
    return _paired(m, lines, headers, "TO--", a, b).select(
        *DOC_KEY, (F.col("moves") * F.col("lines")).alias("n_pairs"),
        _times("qty", "lines").alias("qty"), _times("value", "lines").alias("totalvalue"),
        _times("amount", "moves").alias("xlineamt"))


def sales_cogs(m: Model, a: date, b: date) -> DataFrame:
    """Cost and revenue of sold goods per document and item."""
    return _listed(m, _sales(m, a, b))


def transfer_cogs(m: Model, a: date, b: date) -> DataFrame:
    """The same for goods sent out by transfer orders."""
    return _listed(m, _transfers(m, a, b))


def sales_returns(m: Model, a: date, b: date) -> DataFrame:
    """Value of returned goods per item, at the rate of the return."""
    lines = (_of_window(m, m.imtemptdt.withColumnRenamed("ximtrnnum", "xdocnum"), "SRE-", a, b).groupBy(*DOC_KEY)
             .agg(F.sum("xrate").alias("rates")))
    headers = m.imtemptrn.withColumnRenamed("ximtmptrn", "xdocnum").select("zid", "xdocnum")
    return (_moved(m, "SRE-", a, b).join(lines, DOC_KEY)
            .join(headers, ["zid", "xdocnum"], "left_semi")
            .groupBy(*KEY)
            .agg(F.sum((F.col("rates") * F.col("raw_qty")).cast("decimal(38,4)")).alias("totamt")))


def _item_rows(m: Model, a: date, b: date) -> DataFrame:
    """Profit per item; central sells by transfer, the other units by order."""
    columns = [*KEY, "totalvalue", "xlineamt"]
    # the item master joins last, when there is one row per item
    sold = (_sales(m, a, b).filter(F.col("zid") != CENTRAL).select(*columns)
            .unionByName(_transfers(m, a, b).filter(F.col("zid") == CENTRAL).select(*columns))
            .groupBy(*KEY)
            .agg(F.round(F.sum("totalvalue"), 1).alias("totalvalue"),
                 F.round(F.sum("xlineamt"), 1).alias("xlineamt")))
    returned = sales_returns(m, a, b).select(*KEY, F.round("totamt", 1).alias("totamt"))
    sales = F.col("xlineamt") - F.coalesce("totamt", F.lit(0))
    return (sold.join(returned, KEY, "left").join(m.caitem.select(*KEY, "xdesc", "xgitem"), KEY)
            .select(*KEY, "xdesc", "xgitem", "totalvalue", sales.alias("final_sales"),
                    (sales + F.col("totalvalue")).alias("gross_profit")))


def item_profit(m: Model, a: date, b: date, total: bool = True) -> DataFrame:
    """Profit of each item with a total row per unit.  Cost values are negative."""
    rows = _item_rows(m, a, b)
    if not total:
        return rows
    return with_totals(rows, [*KEY, "xdesc", "xgitem"], ["zid"],
                       ["totalvalue", "final_sales", "gross_profit"], "xdesc", TOTAL_LABEL)


def gl_income_expenditure(m: Model, a: date, b: date) -> DataFrame:
    """Ledger totals by account class without the unit's cost-of-goods account."""
    sums = gl_entries(m, start=a, end=b).groupBy("zid", "xacc").agg(F.sum("xprime").alias("amount"))
    accounts = m.glmst.filter(F.col("xacctype").isin("Income", "Expenditure")).select("zid", "xacc", "xacctype")
    config = m.tenant_config.select("zid", F.col("cogs_account").alias("xacc"))
    return (sums.join(accounts, ["zid", "xacc"]).join(config, ["zid", "xacc"], "left_anti")
            .groupBy("zid", "xacctype").agg(F.sum("amount").alias("amount")))


def business_profit_summary(m: Model, a: date, b: date) -> DataFrame:
    """One row per unit, also without sales: item profit, ledger income and expenditure, net."""
    items = _item_rows(m, a, b).groupBy("zid").agg(
        *[F.sum(c).alias(c) for c in ("totalvalue", "final_sales", "gross_profit")])
    side = lambda kind: F.sum(F.when(F.col("xacctype") == kind, F.col("amount")))
    ledger = gl_income_expenditure(m, a, b).groupBy("zid").agg(
        side("Income").alias("income"), side("Expenditure").alias("expenditure"))
    zero = F.lit(0)
    money = {
        **{c: F.coalesce(c, zero) for c in ("totalvalue", "final_sales", "gross_profit")},
        "income_gl": F.coalesce("income", zero), "expenditure_gl": F.coalesce("expenditure", zero),
        "net": F.coalesce("gross_profit", zero) - F.coalesce("expenditure", zero),
    }
    return (m.tenant.join(items, "zid", "left").join(ledger, "zid", "left")
            .select("zid", "name", *[F.round(v, 1).alias(n) for n, v in money.items()]))


def group_profit_ratio(m: Model, a: date, b: date) -> DataFrame:
    """Profit per item group and unit, over all items of the group."""
    return (item_profit(m, a, b, total=False).groupBy("zid", "xgitem")
            .agg(*[F.sum(c).alias(c) for c in ("totalvalue", "final_sales", "gross_profit")])
            .withColumn("profit_ratio", ratio(F.col("gross_profit") * -100, F.col("totalvalue"))))
