"""Web orders: scope, age, status labels, report sections and lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import constant_table, day, lookup

RECENT_DAYS, ALL_DAYS = 5, 6000

# The statuses of the report and the days each one looks back.
STATUSES = {
    "processing": ALL_DAYS,
    "order-confirmed": ALL_DAYS,
    "will-ecourier": ALL_DAYS,
    "will-sundarban": ALL_DAYS,
    "consundorban": ALL_DAYS,
    "on-the-way-to-del": ALL_DAYS,
    "order-cancelled": RECENT_DAYS,
    "completed": RECENT_DAYS,
}

# Display names of six statuses; the others keep their name.
LABELS = {
    "will-ecourier": "Redx Done",
    "will-sundarban": "Sundarban order confirmed",
    "consundorban": "Sundarban courier done",
    "on-the-way-to-del": "Out for delivery in Dhaka",
    "order-cancelled": "Cancelled by Customer",
    "completed": "Order Completed",
}

EMPTY_SECTION = "no orders"


def moment(col: str) -> Column:
    """Timestamp of a landed field; unreadable text becomes NULL."""
    return F.col(col).try_cast("timestamp_ntz")


def orders_in_scope(orders: DataFrame, as_of: date) -> DataFrame:
    """Orders of the report's statuses within each status' look-back."""
    back = lookup(F.col("status"), STATUSES)
    created = moment("date_created")
    start = F.date_sub(day(as_of), back).cast("timestamp_ntz")
    return orders.filter(
        F.col("status").isin(*STATUSES) & (created > start) & (created.cast("date") <= day(as_of)))


def typed(orders: DataFrame) -> DataFrame:
    """Landed documents with dates and money in types of their own; what cannot be read is NULL."""
    return orders.select(
        "id", "status", moment("date_created").alias("date_created"), moment("date_completed").cast("date").alias("date_completed"),
        moment("date_modified").cast("date").alias("date_modified"), F.col("total").try_cast("decimal(18,2)").alias("total"),
        "customer_note")


def order_age(orders: DataFrame, as_of: date) -> DataFrame:
    """Days from creation to completion, or to ``as_of`` while the order is open."""
    created = moment("date_created").cast("date")
    completed = moment("date_completed").cast("date")
    done = F.col("status") == "completed"
    days = F.when(done & completed.isNotNull(), F.datediff(completed, created)).otherwise(
        F.datediff(day(as_of), created))
    text = F.concat(days.cast("string"), F.lit(" days"))
    message = F.when(done, F.concat(F.lit("completed within "), text)).otherwise(
        F.concat(text, F.lit(" pass after created")))
    return orders.select("id", "status", created.alias("date_created"),
                         completed.alias("date_completed"), "total",
                         *[c for c in ("customer_note",) if c in orders.columns],
                         days.alias("days_for_order"), message.alias("days_pass_order"))


def order_status_label(orders: DataFrame) -> DataFrame:
    status = F.col("status")
    return orders.withColumn("now_status", F.coalesce(lookup(status, LABELS), status))


def order_sections(orders: DataFrame, as_of: date) -> DataFrame:
    """Count, total and oldest date of each report section, in report order."""
    place = {LABELS.get(s, s): i for i, s in enumerate(STATUSES, start=1)}
    return (order_status_label(orders_in_scope(orders, as_of)).groupBy("now_status")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.sum(F.col("total").try_cast("decimal(18,2)")).alias("total"),
                 F.min(moment("date_created").cast("date")).alias("oldest"))
            .select(lookup(F.col("now_status"), place).alias("section"),
                    F.col("now_status").alias("label"), "n_orders", "total", "oldest"))


def order_section_detail(orders: DataFrame, as_of: date) -> DataFrame:
    """Orders of all sections; within a section the oldest comes first."""
    place = {s: i for i, s in enumerate(STATUSES, start=1)}
    aged = order_status_label(order_age(orders_in_scope(orders, as_of), as_of))
    return (aged.withColumn("section", lookup(F.col("status"), place))
            .orderBy("section", "date_created", "id"))


def order_sections_complete(orders: DataFrame, as_of: date) -> DataFrame:
    """Every section of the report, also the empty ones, with a placeholder note."""
    listed = [(i, LABELS.get(s, s)) for i, s in enumerate(STATUSES, start=1)]
    sections = constant_table(orders.sparkSession, "section int, label string", listed)
    found = order_sections(orders, as_of).drop("section")
    return (sections.join(found, "label", "left")
            .select("section", "label", F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
                    F.coalesce("total", F.lit(0)).alias("total"), "oldest",
                    F.when(F.col("n_orders").isNull(), EMPTY_SECTION).alias("note")))


def order_lines(orders: DataFrame, since: date | None = None) -> DataFrame:
    """One row per line of the nested order documents."""
    if since is not None:
        orders = orders.filter(moment("date_created") > day(since).cast("timestamp_ntz"))
    return (orders.select(F.col("id").alias("order_id"), "status",
                          moment("date_created").cast("date").alias("date_created"),
                          F.explode("line_items").alias("line"))
            .select("order_id", "status", "date_created", F.col("line.id").alias("product_id"),
                    F.col("line.sku").alias("sku")))
