"""Price reconciliation between the web shop and the ERP item master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.model import ECOMMERCE, STORE


def price_compare(products: DataFrame, items: DataFrame, zid: int) -> DataFrame:
    """Web price next to the price of one unit.

    Products without a code are dropped before the join.  A price that is no
    number becomes NULL and is neither below nor above.
    """
    erp = items.filter(F.col("zid") == zid).select("xitem", F.col("xstdprice").alias("erp_price"))
    web = (products.filter("sku <> '' and regular_price is not null")
           .select("id", F.col("sku").alias("xitem"),
                   F.col("regular_price").try_cast("decimal(18,2)").alias("web_price")))
    less = F.coalesce(F.col("web_price") < F.col("erp_price"), F.lit(False))
    more = F.coalesce(F.col("web_price") > F.col("erp_price"), F.lit(False))
    return (web.join(erp.filter("erp_price is not null"), "xitem")
            .select("id", "xitem", "web_price", "erp_price",
                    less.alias("web_below_erp"), more.alias("web_above_erp")))


def erp_price_updates(products: DataFrame, items: DataFrame, zid: int = ECOMMERCE,
                      target: str = "web") -> DataFrame:
    """ERP items priced above the web: current price and the price to set.

    ``target="erp_truncated"`` sets the ERP's own price cut to whole units.
    """
    low = price_compare(products, items, zid).filter("web_below_erp")
    whole = F.col("erp_price").cast("bigint").cast("decimal(18,2)")
    wanted = whole if target == "erp_truncated" else F.col("web_price")
    return low.select("xitem", F.col("erp_price").alias("current_price"), wanted.alias("target_price"))


def web_price_updates(products: DataFrame, items: DataFrame, zid: int = STORE) -> DataFrame:
    """Products below the store price with the store price in whole units."""
    return (price_compare(products, items, zid).filter("web_below_erp")
            .select("id", F.col("erp_price").cast("bigint").alias("regular_price")))


def store_cheaper(products: DataFrame, items: DataFrame, zid: int = STORE) -> DataFrame:
    return (price_compare(products, items, zid).filter("web_above_erp")
            .select("id", "xitem", "web_price", F.col("erp_price").alias("store_price")))
