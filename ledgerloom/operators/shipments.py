"""Shipment tracking: margins and stock identities of received import goods.

Each received item needs the movements of three units since its receipt.  A
range join would pair every receipt with every later movement of the item.
Here movements are summed per (item, day) first, and a running total from the
newest day backwards gives "since day d" for every day at once: the window
sees at most one row per calendar day of an item, however many movements,
receipts or orders the item has.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import day, ratio
from ledgerloom.model import CENTRAL, ECOMMERCE, STORE, Model
from ledgerloom.operators.purchasing import ordered_by_date, purchase_receipts

# Running totals: column, unit, document type, sign that makes the usual direction positive.
FLOWS = [
    ("transfer", CENTRAL, "TO--", -1),
    ("creturn", CENTRAL, "SRE-", 1),
    ("greturn", STORE, "SRE-", 1),
    ("ereturn", ECOMMERCE, "SRE-", 1),
    ("gpreturn", STORE, "PRE-", -1),
    ("epreturn", ECOMMERCE, "PRE-", -1),
    ("gsales", STORE, "CO--", -1),
    ("esales", ECOMMERCE, "CO--", -1),
]
ORDERED = [("gpurchase", STORE), ("epurchase", ECOMMERCE)]
BALANCES = [("cstock", CENTRAL), ("gstock", STORE), ("estock", ECOMMERCE)]
PRICES = [("cprice", CENTRAL), ("gprice", STORE), ("eprice", ECOMMERCE)]

# Checks and margins of a received line.  Purchase returns count positive in both shops.
MARGINS = {
    "price_check": "try_divide(cast((gprice - cprice) * 100 AS double), cast(cprate AS double))",
    "store_price_check": "gprice - eprice",
    "central_check": "cpqty - transfer - cstock + creturn",
    "store_check": "gpurchase - gpreturn - gsales + greturn - gstock",
    "ecommerce_check": "epurchase - epreturn - esales + ereturn - estock",
    "total_cpgp": "(cprice - cprate) * cpqty",
    "total_rgp": "(gprice - cprice) * cpqty",
    "total_cgp": "(cprice - cprate) * transfer",
    "total_ggp": "(gprice - cprice) * gsales",
    "total_egp": "(eprice - cprice) * esales",
}

# Report lines of the shipment summary: subject and the totals it adds up.
SUMMARY = [
    ("Total Possible Gross Profit", ["total_pgp"]),
    ("Running Gross Profit", ["total_gp"]),
    ("Total Possible Gross Profit Central", ["total_cpgp"]),
    ("Central Running Gross Profit", ["total_cgp"]),
    ("Total Possible Retail Gross Profit", ["total_rgp"]),
    ("Store Running Gross Profit", ["total_ggp"]),
    ("E-commerce Running Gross Profit", ["total_egp"]),
    ("Retail Running Gross Profit", ["total_ggp", "total_egp"]),
]


def _daily(m: Model, as_of: date, items: DataFrame) -> DataFrame:
    """Movements and orders of some items by day, one column per measure; other items are never grouped."""
    names = [f[0] for f in FLOWS] + [b[0] for b in BALANCES] + [o[0] for o in ORDERED]

    def filled(df: DataFrame) -> DataFrame:
        return df.selectExpr("xitem", "xdate", *[
            f"cast({f'coalesce({n}, 0)' if n in df.columns else 0} AS decimal(38,2)) AS {n}" for n in names])

    history = m.imtrn.filter(F.col("xdate") <= day(as_of)).join(items, "xitem", "left_semi")
    moves = history.groupBy("xitem", "xdate").agg(
        *[F.expr(f"sum(xqty * xsign * {sign}) FILTER (WHERE zid = {unit} AND startswith(xdocnum, '{doc}')) AS {name}")
          for name, unit, doc, sign in FLOWS],
        *[F.expr(f"sum(xqty * xsign) FILTER (WHERE zid = {unit}) AS {name}") for name, unit in BALANCES])
    sold = F.col("zid").isin([unit for _, unit in ORDERED]) & (F.col("xdate") <= day(as_of))
    orders = ordered_by_date(m, items).filter(sold).groupBy("xitem", "xdate").agg(
        *[F.expr(f"sum(qty) FILTER (WHERE zid = {unit}) AS {name}") for name, unit in ORDERED])
    return filled(moves).unionByName(filled(orders))


def shipment_tracking(m: Model, as_of: date, since: date) -> DataFrame:
    """One row per received import line of central ordered after ``since``."""
    lines = purchase_receipts(m, since, CENTRAL, after=True)
    received = lines.select("xitem", "xdate").distinct()
    daily = _daily(m, as_of, received.select("xitem").distinct())
    flows = [f[0] for f in FLOWS] + [o[0] for o in ORDERED]
    balances = [b[0] for b in BALANCES]
    days = (daily.unionByName(received, allowMissingColumns=True)
            .groupBy("xitem", "xdate")
            .agg(*[F.expr(f"cast(coalesce(sum({c}), 0) AS decimal(38,2)) AS {c}") for c in flows + balances]))
    later = "PARTITION BY xitem ORDER BY xdate DESC ROWS UNBOUNDED PRECEDING"
    timeline = days.selectExpr(
        "xitem", "xdate",
        *[f"cast(sum({c}) OVER ({later}) AS decimal(38,2)) AS {c}" for c in flows],
        *[f"cast(sum({c}) OVER (PARTITION BY xitem) AS decimal(38,2)) AS {c}" for c in balances])
    prices = m.caitem.groupBy("xitem").agg(
        *[F.expr(f"max(xstdprice) FILTER (WHERE zid = {unit}) AS {name}") for name, unit in PRICES])
    names = m.caitem.filter(F.col("zid") == CENTRAL).select("xitem", "xdesc", "xgitem")
    base = (lines.join(timeline, ["xitem", "xdate"])
            .join(prices, "xitem", "left").join(names, "xitem", "left")
            .selectExpr("xgrnnum", "xdate AS cpdate", "xitem", "xqtyord AS cpqty", "xrate AS cprate",
                        "xdesc", "xgitem", *flows, *balances,
                        *[f"coalesce({name}, 0) AS {name}" for name, _ in PRICES]))
    margins = base.selectExpr("*", *[f"{formula} AS {name}" for name, formula in MARGINS.items()])
    return (margins.selectExpr("*", "total_cpgp + total_rgp AS total_pgp",
                               "total_cgp + total_ggp + total_egp AS total_gp")
            .withColumn("gp_percent", ratio(F.col("total_gp") * 100, F.col("total_pgp"))))


def shipment_errors(tracking: DataFrame) -> DataFrame:
    """Rows with a price mismatch or a stock identity that does not close."""
    checks = ["store_price_check", "central_check", "store_check", "ecommerce_check"]
    tagged = F.inline(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.col(n).cast("decimal(38,2)").alias("residual"))
        for n in checks]))
    return (tracking.select("xgrnnum", "xitem", "cpdate", "cpqty", "cprate", tagged)
            .filter(F.col("residual") != 0))


def shipment_summary(tracking: DataFrame) -> DataFrame:
    """Nine totals per receipt, one row each."""
    parts = sorted({p for _, ps in SUMMARY for p in ps})
    totals = tracking.groupBy("xgrnnum").agg(*[F.sum(p).alias(p) for p in parts])
    percent = F.coalesce(ratio(F.col("total_gp") * 100, F.col("total_pgp")), F.lit(0.0))
    rows = [(s, F.round(sum((F.col(p) for p in ps[1:]), F.col(ps[0])), 2).cast("double"))
            for s, ps in SUMMARY]
    rows.append(("% of Gross Profit", percent))
    return totals.select("xgrnnum", F.inline(F.array(*[
        F.struct(F.lit(s).alias("subject"), v.alias("result")) for s, v in rows])))


def shipment_zero_stock(tracking: DataFrame) -> DataFrame:
    """Received items the store has none of."""
    return tracking.filter(F.col("gstock") <= 0).select("xgrnnum", "xitem", "xdesc", "gstock")
