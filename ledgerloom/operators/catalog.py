"""Catalog maintenance: attribute codes, new item codes, item upsert."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import newest
from ledgerloom.functions.numbering import dense_numbers
from ledgerloom.operators.stock import KEY

# Sheet column and attribute type under which its values are registered.
ATTRIBUTES = {
    "xeccrange": "Measurement Unit 1",
    "xrandom": "Measurement Unit 2",
    "xnameonly": "Measurement Unit 3",
    "xbrand": "Brand",
    "xcolor": "Color",
    "xmaterial": "Material",
}

# The 27 attributes that a sheet may change on an existing item.
UPDATABLE = [
    "xlong", "xdesc", "xstdcost", "xstdprice", "xduty", "xorigin", "xsup", "xwtunit", "xunitwt",
    "xitemnew", "xitemold", "xdrawing", "xeccnum", "xunitlen", "xl", "xw", "xh", "xbrand",
    "xalias", "xcolor", "xmaterial", "xeccrange", "xscode", "xrandom", "xresponse", "xnameonly",
    "xslot",
]


def attribute_codes(sheet: DataFrame) -> DataFrame:
    """Distinct attribute values of a sheet; a missing value is no code."""
    cells = F.inline(F.array(*[
        F.struct(F.lit(kind).alias("xtype"), F.col(c).cast("string").alias("xcode"))
        for c, kind in ATTRIBUTES.items() if c in sheet.columns]))
    return sheet.select("zid", cells).filter(F.col("xcode").isNotNull()).distinct()


def missing_codes(sheet: DataFrame, xcodes: DataFrame) -> DataFrame:
    return attribute_codes(sheet).join(xcodes, ["zid", "xtype", "xcode"], "left_anti")


def catalog_existing(sheet: DataFrame, items: DataFrame) -> DataFrame:
    return sheet.join(items.select(*KEY), KEY, "left_semi")


def catalog_new(sheet: DataFrame, items: DataFrame) -> DataFrame:
    return sheet.join(items.select(*KEY), KEY, "left_anti")


def _largest_suffix(items: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Largest number after the first dash among the items that start with a prefix.

    "Starts with" becomes an equality by listing the leading parts of each
    code, as long as the prefixes are; the maximum per part is formed before
    the join.
    """
    # a few distinct lengths, however many prefixes
    sizes = prefixes.agg(F.sort_array(F.collect_set(F.length("prefix")))).scalar()
    second = F.try_element_at(F.split("xitem", "-"), F.lit(2))
    number = F.when(second.rlike("^[0-9]+$"), second.try_cast("bigint"))
    parts = (items.select("zid", "xitem", number.alias("number")).filter(F.col("number").isNotNull())
             .select("zid", "number", "xitem", F.explode(sizes).alias("size"))
             .filter(F.col("size") <= F.length("xitem"))
             .select("zid", F.expr("substr(xitem, 1, size)").alias("prefix"), "number")
             .groupBy("zid", "prefix").agg(F.max("number").alias("largest")))
    return prefixes.join(parts, ["zid", "prefix"], "left")


def generate_item_codes(new: DataFrame, items: DataFrame, row: str = "row_id") -> DataFrame:
    """Next free numbers for new rows whose code is a bare prefix, in sheet order."""
    prefixed = new.withColumn("prefix", F.col("xitem"))
    # the number of prefixes is the number of distinct codes, not of rows
    start = _largest_suffix(items, prefixed.select("zid", "prefix").distinct())
    numbered = dense_numbers(prefixed, row, by=("zid", "prefix"))
    return (numbered.join(start, ["zid", "prefix"])
            .withColumn("new_code", F.concat(
                "prefix", (F.coalesce("largest", F.lit(0)) + F.col("rn")).cast("string")))
            .drop("rn", "largest"))


def new_item_defaults(new: DataFrame, warehouse: str, ts: datetime) -> DataFrame:
    # Category, stock type and conversion factors of a new item.
    return new.withColumns({
        "ztime": F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz"),
        "xcatful": F.lit("Auto"),
        "xtypestk": F.lit("Stock-N-Sell"),
        "xwh": F.lit(warehouse),
        "xcfiss": F.lit(1),
        "xcfpck": F.lit(1),
        "xcfsta": F.lit(1),
    })


def catalog_upsert(items: DataFrame, sheet: DataFrame, row: str = "row_id", warehouse: str | None = None,
                   ts: datetime | None = None) -> DataFrame:
    """Next state of the item table, with all of its columns.

    A listed item takes the sheet's values of the updatable attributes, from
    its first sheet row; other items stay; unknown rows are appended under
    generated codes, with the defaults of a new item where ``warehouse`` and
    ``ts`` are given.  The group of an existing item does not change.
    """
    shared = [c for c in items.columns if c in sheet.columns and c in UPDATABLE]
    listed = catalog_existing(sheet, items)
    # the largest negated row number is the first row
    first = (listed.withColumn("_order", -F.col(row)).groupBy(*KEY)
             .agg(newest(["_order"], shared).alias("s")))
    updated = items.join(first, KEY, "left").select(
        *[F.when(F.col("s").isNotNull(), F.col(f"s.{c}")).otherwise(F.col(c)).alias(c)
          if c in shared else F.col(c) for c in items.columns],
        F.when(F.col("s").isNotNull(), "updated").otherwise("kept").alias("action"))
    added = generate_item_codes(catalog_new(sheet, items), items, row)
    if warehouse is not None and ts is not None:
        added = new_item_defaults(added, warehouse, ts)
    inserted = added.select(
        *[F.col("new_code").alias("xitem") if c == "xitem" else F.col(c)
          for c in items.columns if c in added.columns],
        F.lit("inserted").alias("action"))
    return updated.unionByName(inserted, allowMissingColumns=True)
