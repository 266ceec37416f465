"""Documents that drift: landed as VARIANT, unknown keys kept, unreadable ones set aside with a reason.

A line is parsed once.  What is no JSON object, lacks its key or holds a value
that its field cannot take goes to a reject table with the line and the reason;
every other document is kept whole, so a field the shop adds tomorrow is there
today, and a number sent as text (or the reverse) is read all the same.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import literal

ITEMS = "array<struct<id: bigint, name: string, sku: string>>"


@dataclass(frozen=True)
class Kind:
    """Fields of a document and their types; those that must be there; those whose text must read as another type."""

    fields: dict[str, str]
    required: tuple[str, ...] = ("id",)
    reads_as: dict[str, str] = field(default_factory=dict)


ORDER = Kind(
    {"id": "bigint", "status": "string", "date_created": "string", "date_modified": "string", "date_completed": "string",
     "total": "string", "customer_note": "string", "line_items": ITEMS},
    reads_as={"date_created": "timestamp_ntz", "date_modified": "timestamp_ntz", "total": "decimal(18,2)"})
PRODUCT = Kind(
    {"id": "bigint", "sku": "string", "regular_price": "string", "shipping_class": "string",
     "categories": "array<struct<id: bigint, name: string>>", "meta_data": "array<struct<key: string, value: string>>"})


def _value(name: str, kind: str) -> Column:
    return F.expr(f"try_variant_get(document, '$.{name}', '{kind}')")


def _there(name: str) -> Column:
    """The key is there and is not null."""
    return F.expr(f"NOT is_variant_null(coalesce(variant_get(document, '$.{name}', 'variant'), parse_json('null')))")


def judge(lines: DataFrame, kind: Kind, text: str = "value") -> DataFrame:
    """``lines`` with ``document`` (VARIANT) and ``reason``: NULL, or everything that is wrong with the line.

    An empty line is no document.  Text that is no JSON, repeats a key or is
    beyond what VARIANT can hold has no document and the reason "not JSON".
    """
    parsed = lines.withColumn("document", F.expr(f"try_parse_json(`{text}`)"))
    # Each value is read once, as a column of its own; whether a key is there matters only without a value.
    read = parsed.withColumns({f"_read_{name}": _value(name, type_) for name, type_ in kind.fields.items()})
    faults = [F.when(~_there(name), F.lit(f"{name}: missing")) for name in kind.required]
    for name, type_ in kind.fields.items():
        value = F.col(f"_read_{name}")
        faults.append(F.when(value.isNull() & _there(name), F.lit(f"{name}: not {type_.split('<')[0]}")))
        if name in kind.reads_as:
            wanted = kind.reads_as[name]
            unread = value.isNotNull() & (value != "") & value.try_cast(wanted).isNull()
            faults.append(F.when(unread, F.lit(f"{name}: not {wanted.split('(')[0]}")))
    wrong = F.concat_ws("; ", *faults)
    an_object = F.expr("schema_of_variant(document)").startswith("OBJECT")
    reason = F.when(F.col("document").isNull(), F.lit("not JSON")).when(~an_object, F.lit("not an object")).when(wrong != "", wrong)
    return read.select(*[f"`{c}`" for c in parsed.columns], reason.alias("reason"))


def typed(documents: DataFrame, kind: Kind) -> DataFrame:
    """Fields of kept documents, and ``more``: the JSON text of keys the kind does not know, NULL without any."""
    known = ", ".join(literal(name) for name in kind.fields)
    more = F.expr(f"map_filter(cast(document AS map<string, variant>), (k, v) -> NOT k IN ({known}))")
    return documents.select(*[_value(n, t).alias(n) for n, t in kind.fields.items()],
                            F.when(F.size(more) > 0, F.to_json(more)).alias("more"))


def land_documents(lines: DataFrame, folder: str, landing: int, kind: Kind, text: str = "value") -> None:
    """Write the documents of one landing as VARIANT and the rejects with their reason; run again, it replaces its own."""
    judged = judge(lines, kind, text).select("document", F.col(text).alias("line"), "reason",
                                             F.when(F.col("reason").isNull(), "kept").otherwise("rejected").alias("fate"))
    # One pass over the lines; a kept line is in its document already.
    (judged.withColumns({"document": F.when(F.col("fate") == "kept", F.col("document")),
                         "line": F.when(F.col("fate") != "kept", F.col("line")), "landing": F.lit(landing)})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("landing", "fate").parquet(folder))


LANDED = "document variant, line string, reason string, landing int, fate string"


def read_documents(spark: SparkSession, folder: str, kind: Kind) -> DataFrame:
    """Typed fields of the kept documents of all landings."""
    return typed(spark.read.schema(LANDED).parquet(folder).where("fate = 'kept'"), kind)


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """(landing, line, reason) of what was set aside."""
    return spark.read.schema(LANDED).parquet(folder).where("fate = 'rejected'").select("landing", "line", "reason")
