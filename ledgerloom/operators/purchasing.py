"""Purchase orders, receipts, last suppliers and receipt checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import at_rate, day, doc_is, newest, rate, ratio, signed_qty
from ledgerloom.model import CENTRAL, STORE, Model
from ledgerloom.operators.stock import KEY, day_over_day_stock, of_unit, only_items

NO_ORDER = "no-order-yet"


def _import_orders(m: Model, prefix: str, status: str) -> DataFrame:
    return (m.poord.filter(doc_is(prefix, "xpornum") & (F.col("xstatuspor") == status))
            .select("zid", "xpornum", F.col("xdate").alias("ordered")))


def purchase_receipts(m: Model, since: date, zid: int | None = CENTRAL, prefix: str = "IP--",
                      status: str = "5-Received", after: bool = False) -> DataFrame:
    """Lines of received import orders with their receipt.

    ``after`` excludes orders of the first day itself.
    """
    orders = of_unit(_import_orders(m, prefix, status), zid)
    window = F.col("ordered") > day(since) if after else F.col("ordered") >= day(since)
    receipts = of_unit(m.pogrn, zid).select("zid", "xpornum", "xgrnnum", "xdate")
    return (of_unit(m.poodt, zid).join(orders.filter(window), ["zid", "xpornum"])
            .join(receipts, ["zid", "xpornum"])
            .select("zid", "xgrnnum", "xdate", "xitem", "xqtyord", "xrate"))


def ordered_by_date(m: Model, items: DataFrame | None = None, since: date | None = None) -> DataFrame:
    """Ordered quantity and rate totals by item and order date, counted once per receipt.

    A line counts as often as its order has receipts.  The receipts are counted
    first, so a line meets one row per order and never multiplies out.  Only
    orders from ``since`` and lines of ``items`` are read into it.
    """
    orders = m.poord if since is None else m.poord.filter(F.col("xdate") >= day(since))
    receipts = m.pogrn.groupBy("zid", "xpornum").agg(F.count(F.lit(1)).alias("n"))
    dated = orders.select("zid", "xpornum", "xdate").join(receipts, ["zid", "xpornum"])
    n = F.col("n").cast("decimal(10,0)")
    return only_items(m.poodt, items).join(dated, ["zid", "xpornum"]).groupBy("zid", "xitem", "xdate").agg(
        F.sum(F.col("xqtyord") * n).cast("decimal(38,2)").alias("qty"),
        F.sum(F.col("xrate") * n).cast("decimal(38,2)").alias("rates"),
        F.sum("n").alias("lines"))


def purchase_summary(m: Model, since: date, items: DataFrame | None = None) -> DataFrame:
    """Ordered quantity and mean rate per item."""
    return (ordered_by_date(m, items, since).groupBy(*KEY)
            .agg(F.sum("qty").alias("ordered_qty"), F.sum("rates").alias("rates"),
                 F.sum("lines").alias("lines"))
            .select(*KEY, "ordered_qty", ratio(F.col("rates"), F.col("lines")).alias("mean_rate")))


def shipment_items(m: Model, since: date, zid: int | None = CENTRAL) -> DataFrame:
    """Distinct items of each receipt, for orders after ``since``."""
    return (purchase_receipts(m, since, zid, after=True)
            .select("zid", "xgrnnum", "xdate", "xitem").distinct())


def shipment_receipts(m: Model, since: date, zid: int | None = CENTRAL) -> DataFrame:
    """First date and number of items of each receipt.

    The items themselves stay rows (``shipment_items``): as a list, a large
    receipt would be one oversized value.
    """
    return shipment_items(m, since, zid).groupBy("zid", "xgrnnum").agg(
        F.min("xdate").alias("first_date"), F.count(F.lit(1)).alias("n_items"))


def supplier_last_receipt(m: Model, zid: int | None = CENTRAL) -> DataFrame:
    return of_unit(m.pogrn, zid).groupBy("zid", "xsup").agg(F.max("xdate").alias("last_receipt"))


def last_supplier_for_orders(m: Model, order_lines: DataFrame, zid: int = CENTRAL) -> DataFrame:
    """Newest purchase of every ordered item.

    Amounts and dates stay NULL for an item that was never bought; the
    placeholder text appears in the text columns only.
    """
    named = F.when(F.col("sku") != "", F.col("sku"))
    wanted = order_lines.select(named.alias("xitem")).where("xitem IS NOT NULL").distinct()
    suppliers = of_unit(m.casup, zid).select("zid", "xsup", "xshort", "xphone")
    bought = (of_unit(m.poodt, zid).select("zid", "xpornum", "xitem", "xrate")
              .join(wanted, "xitem", "left_semi")
              .join(of_unit(m.poord, zid).select("zid", "xpornum", "xsup", "xdate"), ["zid", "xpornum"])
              .join(suppliers, ["zid", "xsup"]))
    last = (bought.groupBy("xitem")
            .agg(newest(["xdate", "xpornum", "xrate", "xsup"], ["xshort", "xphone"]).alias("p")))
    text = lambda c: F.coalesce(F.col(c), F.lit(NO_ORDER))
    # Lines without a code share one value, NULL or empty; they have no purchase and skip the join.
    coded = order_lines.where("sku <> ''").withColumnRenamed("sku", "xitem").join(last, "xitem", "left")
    bare = order_lines.where("sku IS NULL OR sku = ''").withColumnRenamed("sku", "xitem")
    return (coded.unionByName(bare, allowMissingColumns=True)
            .select(F.col("xitem").alias("item_code"), "order_id", "date_created", "status",
                    text("p.xsup").alias("supplier_code"), text("p.xshort").alias("supplier_name"),
                    text("p.xphone").alias("supplier_mobile"),
                    F.col("p.xdate").alias("last_purchase_date"),
                    text("p.xpornum").alias("last_po_number"),
                    F.col("p.xrate").alias("last_purchase_price")))


def sales_of_purchase(m: Model, since: date, zid: int | None = STORE,
                      legacy_totals: bool = False) -> DataFrame:
    """Receipts of each item and day after ``since`` next to its stock and sales.

    Stock and sales repeat for each receipt day of an item.  The sales total
    counts an item once; ``legacy_totals`` counts it once per receipt day.
    """
    moved = of_unit(m.imtrn, zid)
    recent = F.col("xdate") > day(since)
    received = moved.filter(recent & doc_is("GRN-"))
    line_rate = rate(F.col("xval"), F.col("xqty"))
    lines = received.groupBy(*KEY, "xdate").agg(
        F.sum(signed_qty()).alias("purchase_qty"),
        rate(F.sum(line_rate), F.count(line_rate)).alias("purchase_rate"))
    totals = moved.groupBy(*KEY).agg(
        F.sum(signed_qty()).alias("stock"),
        F.coalesce(F.sum(F.when(recent & doc_is("CO-"), signed_qty())), F.lit(0)).alias("sales_qty"),
        F.min(F.when(recent & doc_is("GRN-"), F.col("xdate"))).alias("first_day"))
    items = of_unit(m.caitem, zid).select(*KEY, "xdesc", "xgitem", "xstdprice")
    detail = (lines.join(totals, KEY, "left").join(items, KEY)
              .withColumn("purchase_value", at_rate(F.col("purchase_qty"), F.col("purchase_rate")))
              .withColumn("sales_value", -F.col("sales_qty") * F.col("xstdprice")))
    once = F.lit(1) if legacy_totals else F.when(F.col("xdate") == F.col("first_day"), 1).otherwise(0)
    grand = detail.groupBy("zid").agg(
        F.sum("purchase_value").alias("purchase_total"),
        F.sum(F.col("sales_value") * once).alias("sales_total"))
    return detail.join(grand, "zid").select(
        *KEY, "xdesc", "xgitem", "xdate", "purchase_qty", "purchase_rate", "purchase_value",
        "stock", "sales_qty", F.col("xstdprice").alias("sales_rate"), "sales_value",
        "purchase_total", "sales_total")


def sales_of_purchase_summary(m: Model, since: date, zid: int | None = STORE) -> DataFrame:
    """Purchases, sales of the purchased items, and -100 x sales / purchases."""
    per_unit = sales_of_purchase(m, since, zid).groupBy("zid").agg(
        F.max("purchase_total").alias("total_purchase"), F.max("sales_total").alias("total_sales"))
    return per_unit.withColumn(
        "sales_percent", ratio(F.col("total_sales") * -100, F.col("total_purchase")))


def receipts_of_day(m: Model, on: date, zid: int | None = STORE) -> DataFrame:
    headers = of_unit(m.pogrn, zid).filter(F.col("xdate") == day(on)).select("zid", "xgrnnum", "xdate")
    return (of_unit(m.pogdt, zid).join(headers, ["zid", "xgrnnum"])
            .join(of_unit(m.caitem, zid).select(*KEY, "xdesc"), KEY)
            .select("zid", "xdate", "xgrnnum", "xitem", "xdesc", F.col("xqty").alias("today_grn_qty")))


def sales_qty_of_day(m: Model, on: date, items: DataFrame | None = None,
                     zid: int | None = STORE) -> DataFrame:
    headers = of_unit(m.opord, zid).filter(F.col("xdate") == day(on)).select("zid", "xordernum")
    lines = of_unit(m.opodt, zid).join(headers, ["zid", "xordernum"], "left_semi")
    return only_items(lines, items).groupBy(*KEY).agg(F.sum("xqtyord").alias("today_sales_qty"))


def receipt_inventory_check(m: Model, on: date, zid: int | None = STORE) -> DataFrame:
    """Items of each receipt of a day with what was posted to stock for the same receipt and item.

    Lines and postings are both summed per (receipt, item), so a receipt that
    repeats an item compares its total with what was posted in total.  A NULL
    ``item_inserted_inv`` means that nothing was posted.
    """
    received = receipts_of_day(m, on, zid).groupBy("zid", "xdate", "xgrnnum", "xitem", "xdesc").agg(
        F.sum("today_grn_qty").alias("today_grn_qty"))
    today = of_unit(m.pogrn, zid).filter(F.col("xdate") == day(on)).select("zid", "xgrnnum")
    items = of_unit(m.pogdt, zid).join(today, ["zid", "xgrnnum"], "left_semi").select(*KEY)
    posted = (of_unit(m.imtrn, zid).withColumnRenamed("xdocnum", "xgrnnum")
              .join(today, ["zid", "xgrnnum"], "left_semi")
              .groupBy("zid", "xgrnnum", "xitem")
              .agg(F.sum("xqty").alias("item_inserted_inv"), F.count(F.lit(1)).alias("inv_rows")))
    return (received
            .join(sales_qty_of_day(m, on, zid=zid), KEY, "left")
            .join(day_over_day_stock(m, on, items), KEY, "left")
            .join(posted, ["zid", "xgrnnum", "xitem"], "left")
            .select("zid", "xdate", "xgrnnum", "xitem", "xdesc", "today_grn_qty", "item_inserted_inv",
                    "inv_rows", F.coalesce("today_sales_qty", F.lit(0)).alias("today_sales_qty"),
                    "yesterday_stock", "today_stock"))
