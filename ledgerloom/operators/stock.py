"""Stock balances, movements and stock changes.

Movements are aggregated by (unit, item) before they meet the item master: the
partial sums shrink a hot item on the map side, and the join then works on one
row per item.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import (
    day,
    doc_is,
    newest,
    rate,
    signed_qty,
    signed_value,
    sum_when,
)
from ledgerloom.model import CENTRAL, ECOMMERCE, STORE, Model

KEY = ["zid", "xitem"]

# A full row of a movement, most significant column first.  Document and line
# numbers repeat in practice, so the amounts are part of the order as well.
MOVEMENT_ORDER = ["xdate", "xdocnum", "xline", "xsup", "xqty", "xval"]

# Document types of the item movement totals.
DOC_TYPES = {"sales": "CO--", "transfers": "TO--", "sales_returns": "SRE-", "purchase_returns": "PRE-"}


def of_unit(df: DataFrame, zid: int | None) -> DataFrame:
    return df if zid is None else df.filter(F.col("zid") == zid)


def only_items(df: DataFrame, items: DataFrame | None) -> DataFrame:
    """Rows of the listed items; a semi join instead of a literal IN list."""
    if items is None:
        return df
    keys = [c for c in KEY if c in items.columns]
    return df.join(items.select(*keys).distinct(), keys, "left_semi")


def inventory_balance(m: Model, zid: int | None = None, as_of: date | None = None) -> DataFrame:
    moved = of_unit(m.imtrn, zid)
    if as_of is not None:
        moved = moved.filter(F.col("xdate") <= day(as_of))
    balance = moved.groupBy(*KEY).agg(
        F.sum(signed_qty()).alias("inventory"), F.max("xdate").alias("last_date"))
    return balance.join(of_unit(m.caitem, zid), KEY).select(
        *KEY, "xdesc", "xgitem", "xbrand", "xstdprice", "inventory", "last_date")


def last_movement(m: Model, doc_prefix: str | None = None, zid: int | None = None) -> DataFrame:
    """Newest movement of each item, of any type or of one document type."""
    moved = of_unit(m.movements_of(doc_prefix) if doc_prefix else m.imtrn, zid)
    return (moved.groupBy(*KEY).agg(newest(MOVEMENT_ORDER, ["xsign"]).alias("last"))
            .select(*KEY, "last.xdate", "last.xdocnum", "last.xqty", "last.xval", "last.xsign"))


def inventory_report(m: Model, stock_zid: int = CENTRAL, rate_zid: int = STORE) -> DataFrame:
    """Stock of one unit with the last rate of another."""
    last = last_movement(m, zid=rate_zid).select("xitem", "xqty", "xval")
    return (inventory_balance(m, stock_zid).join(last, "xitem", "left")
            .withColumn("xrate", rate(F.col("xval"), F.col("xqty")))
            .select("zid", "xitem", "xdesc", "xgitem", "xstdprice", "inventory", "xqty", "xval", "xrate"))


def inventory_value_by_warehouse(m: Model, as_of: date) -> DataFrame:
    return (m.imtrn.filter(F.col("xdate") <= day(as_of))
            .groupBy("zid", "xwh").agg(F.sum(signed_value()).alias("value")))


def inventory_value_totals(m: Model, as_of: date) -> DataFrame:
    """One value per unit over the warehouses whose name holds the unit's text.

    A warehouse without a name never matches.
    """
    hit = F.coalesce(F.contains(F.col("xwh"), F.col("warehouse_text")), F.lit(False))
    return (inventory_value_by_warehouse(m, as_of)
            .join(m.tenant_config, "zid").join(m.tenant, "zid")
            .groupBy("zid", "name")
            .agg(F.round(sum_when(hit, F.col("value")), 2).alias("value")))


def stock_as_of(m: Model, as_of: date, items: DataFrame | None = None) -> DataFrame:
    moved = m.imtrn.filter(F.col("xdate") <= day(as_of))
    return only_items(moved, items).groupBy(*KEY).agg(F.sum(signed_qty()).alias("stock"))


def movement_totals(m: Model, since: date, items: DataFrame | None = None) -> DataFrame:
    """Signed quantity per item and document type, all types in one pass."""
    chosen = F.lit(False)
    for prefix in DOC_TYPES.values():
        chosen = chosen | doc_is(prefix)
    moved = m.imtrn.filter((F.col("xdate") >= day(since)) & chosen)
    return only_items(moved, items).groupBy(*KEY).agg(*[
        sum_when(doc_is(prefix), signed_qty()).alias(name) for name, prefix in DOC_TYPES.items()
    ])


def day_over_day_stock(m: Model, on: date, items: DataFrame | None = None) -> DataFrame:
    """Closing stock of a day and of the day before, 0 where there was none."""
    before = F.col("xdate") <= day(on - timedelta(days=1))
    moved = m.imtrn.filter(F.col("xdate") <= day(on))
    return only_items(moved, items).groupBy(*KEY).agg(
        sum_when(before, signed_qty()).alias("yesterday_stock"),
        F.sum(signed_qty()).alias("today_stock"))


def _units(value: Column) -> Column:
    """Whole units; the fraction is cut, not rounded."""
    return F.coalesce(value, F.lit(0)).cast("bigint")


def multi_branch_stock(m: Model, as_of: date | None = None, balances: DataFrame | None = None) -> DataFrame:
    """Stock of the three units side by side, for items that central holds.

    ``balances`` (zid, xitem, inventory), where they are kept already, stand in for the movements.
    """
    if balances is None:
        moved = m.imtrn if as_of is None else m.imtrn.filter(F.col("xdate") <= day(as_of))
        balances = moved.groupBy(*KEY).agg(F.sum(signed_qty()).alias("inventory"))
    held = balances.join(m.caitem.select(*KEY), KEY, "left_semi")
    units = {"central": CENTRAL, "store": STORE, "ecommerce": ECOMMERCE}
    side_by_side = held.groupBy("xitem").agg(
        F.count(F.when(F.col("zid") == CENTRAL, 1)).alias("held"),
        *[_units(F.sum(F.when(F.col("zid") == zid, F.col("inventory")))).alias(name)
          for name, zid in units.items()])
    names = of_unit(m.caitem, CENTRAL).select("xitem", F.col("xdesc").alias("name"))
    return side_by_side.filter("held > 0").join(names, "xitem").select(
        F.col("xitem").alias("sku"), "name", *units,
        (F.col("central") + F.col("store") + F.col("ecommerce")).alias("sum_of_stock"))


def mark_changes(current: DataFrame, previous: DataFrame, key: str | list[str] = "sku",
                 value: str = "sum_of_stock") -> DataFrame:
    """Current rows with the value of the earlier snapshot and whether it changed."""
    keys = [key] if isinstance(key, str) else key
    old = previous.select(*keys, F.col(value).alias("previous"))
    return (current.join(old, keys, "left")
            .withColumn("changed", ~F.col(value).eqNullSafe(F.col("previous"))))


def stock_changes(current: DataFrame, previous: DataFrame, key: str | list[str] = "sku",
                  value: str = "sum_of_stock") -> DataFrame:
    """Rows whose value differs from the earlier snapshot; a new row is a change."""
    return mark_changes(current, previous, key, value).filter("changed").drop("changed")


def negative_movements(m: Model, on: str = "last") -> DataFrame:
    """Items whose last movement has a negative quantity, or whose balance is negative."""
    balance = inventory_balance(m)
    if on == "balance":
        return balance.filter(F.col("inventory") < 0).select(
            *KEY, "xdesc", "inventory", "last_date")
    last = last_movement(m).filter(F.col("xqty") < 0).select(*KEY, "xqty", "xval")
    return balance.join(last, KEY).select(*KEY, "xdesc", "inventory", "last_date", "xqty", "xval")


def shipping_class(products: DataFrame, stock: DataFrame, previous: DataFrame) -> DataFrame:
    """New class of products whose stock changed since ``previous`` or that have none.

    Products without a code never match stock; they skip the join, so their
    common empty key does not land in one task.
    """
    coded = F.col("sku") != ""
    unclassed = F.coalesce(F.col("shipping_class"), F.lit("")) == ""
    marked = mark_changes(stock, previous).select("sku", "central", "store", "ecommerce", "changed")
    known = (products.filter(coded).join(marked, "sku", "left")
             .filter(F.coalesce(F.col("changed"), F.lit(False)) | unclassed))
    near = F.col("store") + F.col("ecommerce")
    rule = (F.when(F.col("central").isNull() | (near + F.col("central") <= 0), "nothouse")
            .when(near > 0, "inhouse").otherwise("nearby"))
    uncoded = products.filter(~F.coalesce(coded, F.lit(False)) & unclassed)
    return (known.select("id", rule.alias("shipping_class"))
            .unionByName(uncoded.select("id", F.lit("nothouse").alias("shipping_class"))))


def stock_quantity_sync(products: DataFrame, stock: DataFrame, drop_zero: bool = False) -> DataFrame:
    """Stock quantities to send to the shop, for products it knows."""
    wanted = stock.filter("sum_of_stock <> 0") if drop_zero else stock
    return (products.filter("sku <> '' and id > 0").select("id", "sku").join(wanted, "sku")
            .select("id", F.col("sum_of_stock").alias("stock_quantity"),
                    F.lit(True).alias("manage_stock")))
