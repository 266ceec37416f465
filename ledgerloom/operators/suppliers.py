"""Supplier analysis: what each supplier's items hold and sell."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import at_rate, days_before, doc_is, rate, signed_qty
from ledgerloom.model import CENTRAL, STORE, Model
from ledgerloom.operators.purchasing import supplier_last_receipt
from ledgerloom.operators.stock import inventory_balance, last_movement, of_unit

CREDIT_DAYS, REST_DAYS = 60, 30


def supplier_item_profile(m: Model, zid: int = CENTRAL) -> DataFrame:
    """Every item with stock, last receipt and each of its suppliers."""
    stock = inventory_balance(m, zid).select("xitem", "inventory")
    last = last_movement(m, "GRN-", zid).select(
        "xitem", F.col("xdate").alias("last_purchase_date"), F.col("xqty").alias("last_purchase_qty"),
        rate(F.col("xval"), F.col("xqty")).alias("purchase_rate"))
    suppliers = (of_unit(m.pogdt, zid).select("zid", "xgrnnum", "xitem")
                 .join(of_unit(m.pogrn, zid).select("zid", "xgrnnum", "xsup"), ["zid", "xgrnnum"])
                 .select("xitem", "xsup").distinct())
    return (of_unit(m.caitem, zid).select("xitem", "xdesc", "xgitem")
            .join(stock, "xitem", "left").join(last, "xitem", "left").join(suppliers, "xitem", "left")
            .select("xitem", "xdesc", "xgitem", "xsup",
                    F.coalesce("inventory", F.lit(0)).alias("central_stock"), "last_purchase_date",
                    F.coalesce("last_purchase_qty", F.lit(0)).alias("last_purchase_qty"),
                    F.coalesce("purchase_rate", F.lit(0)).alias("purchase_rate")))


def _with_store(m: Model, profile: DataFrame, as_of: date, days: int, zid: int) -> DataFrame:
    """Add the store's stock, price and recent sales.

    Missing stock counts as 0 before the total is formed, so an item the store
    does not hold keeps its central stock.
    """
    store = inventory_balance(m, zid).select(
        "xitem", F.col("inventory").alias("store_stock"), F.col("xstdprice").alias("sales_price"))
    sold = (of_unit(m.imtrn, zid).filter(doc_is("CO-") & (F.col("xdate") > days_before(as_of, days)))
            .groupBy("xitem").agg(F.sum(signed_qty()).alias("store_sale")))
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("store_stock", "sales_price", "store_sale")]
    return (profile.join(store, "xitem", "left").join(sold, "xitem", "left")
            .select(*profile.columns, *filled)
            .withColumn("total_stock", F.col("central_stock") + F.col("store_stock")))


def credit_supplier_detail(m: Model, suppliers: DataFrame, as_of: date, central: int = CENTRAL,
                           store: int = STORE) -> DataFrame:
    listed = supplier_item_profile(m, central).join(suppliers.select("xsup").distinct(), "xsup", "left_semi")
    last = supplier_last_receipt(m, central).select("xsup", F.col("last_receipt").alias("last_supplier_date"))
    return _with_store(m, listed, as_of, CREDIT_DAYS, store).join(last, "xsup", "left")


def rest_supplier_detail(m: Model, suppliers: DataFrame, as_of: date, central: int = CENTRAL,
                         store: int = STORE) -> DataFrame:
    rest = (supplier_item_profile(m, central).filter(F.col("xsup").isNotNull())
            .join(suppliers.select("xsup").distinct(), "xsup", "left_anti"))
    return _with_store(m, rest, as_of, REST_DAYS, store).withColumn(
        "sales_since", days_before(as_of, REST_DAYS))


def _values() -> list:
    return [
        F.round(F.sum(at_rate(F.col("total_stock"), F.col("purchase_rate"))), 2).alias("inventory_purchase_value"),
        F.round(F.sum(F.col("total_stock") * F.col("sales_price")), 2).alias("inventory_sale_value"),
        F.round(F.sum(-F.col("store_sale") * F.col("sales_price")), 2).alias("total_sales"),
    ]


def credit_supplier_financials(detail: DataFrame) -> DataFrame:
    return (detail.groupBy("xsup").agg(*_values(), F.max("last_supplier_date").alias("purchase_date"))
            .withColumn("difference", F.col("total_sales") - F.col("inventory_sale_value")))


def rest_supplier_financials(detail: DataFrame) -> DataFrame:
    return (detail.groupBy("xsup").agg(*_values())
            .withColumn("difference", F.col("total_sales") - F.col("inventory_sale_value")))
