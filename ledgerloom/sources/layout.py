"""Ledger tables laid out for their joins: bucketed and sorted by the key they meet on.

Vouchers meet their lines by (unit, voucher) and movements their items by (unit,
item).  Written once into the same number of buckets by that key, both sides are
joined and summed where they lie, without a shuffle.  A bucket holds its keys
whole, so choose enough of them that the largest key is small beside a bucket.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession

from ledgerloom.model import Model
from ledgerloom.schemas import TABLES
from ledgerloom.streaming.keyed import Files

#: Key of each table that is laid out.
LAYOUT = {
    "glheader": ["zid", "xvoucher"], "gldetail": ["zid", "xvoucher"],
    "imtrn": ["zid", "xitem"], "caitem": ["zid", "xitem"],
    "pogrn": ["zid", "xgrnnum"], "pogdt": ["zid", "xgrnnum"],
    "opord": ["zid", "xordernum"], "opodt": ["zid", "xordernum"],
}
SPEC = "layout.json"
#: Rows of a bucket, about; a task reads a bucket whole.
PER_BUCKET = 250_000


def buckets_for(m: Model, tables: Iterable[str], least: int = 1, per_bucket: int = PER_BUCKET) -> int:
    """So many buckets that the largest of the tables has about ``per_bucket`` rows in each."""
    return max(least, *[-(-getattr(m, name).count() // per_bucket) for name in tables])


def write_layout(m: Model, folder: str, buckets: int, tables: Iterable[str] = tuple(LAYOUT), catalog_prefix: str = "laid_") -> None:
    """Write tables of a model in buckets below ``folder`` and note their layout there."""
    spark = m.spark
    names = list(tables)
    for name in names:
        key = LAYOUT[name]
        df = getattr(m, name)
        columns = [c for c in spark.createDataFrame([], TABLES[name]).columns if c in df.columns]
        spark.sql(f"DROP TABLE IF EXISTS {catalog_prefix}{name}")
        # Dealt out as the buckets are, a task writes whole buckets: one file each.
        (df.select(*columns).repartition(buckets, *key).write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
         .option("path", f"{folder}/{name}").saveAsTable(f"{catalog_prefix}{name}"))
    schemas = {n: spark.table(f"{catalog_prefix}{n}").schema.toDDL() for n in names}
    Files(spark).write(f"{folder}/{SPEC}", json.dumps({"buckets": buckets, "keys": {n: LAYOUT[n] for n in names}, "schemas": schemas}))


def open_layout(spark: SparkSession, folder: str, base: Model | None = None, catalog_prefix: str = "laid_") -> Model:
    """Model over tables that some session laid out; those that were not come from ``base``."""
    spec = json.loads(Files(spark).read(f"{folder}/{SPEC}"))
    for name, key in spec["keys"].items():
        by = ", ".join(key)
        spark.sql(f"DROP TABLE IF EXISTS {catalog_prefix}{name}")
        spark.sql(f"CREATE TABLE {catalog_prefix}{name} ({spec['schemas'][name]}) USING parquet "
                  f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {spec['buckets']} BUCKETS LOCATION '{folder}/{name}'")
    laid = {n: (lambda n=n: spark.table(f"{catalog_prefix}{n}")) for n in spec["keys"]}
    return Model(spark, laid) if base is None else base.replace(**{n: build() for n, build in laid.items()})
