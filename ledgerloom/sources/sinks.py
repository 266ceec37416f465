"""Report, snapshot and payload sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbering import dense_numbers


def write_report(df: DataFrame, path: str, by: str = "zid", fmt: str = "parquet") -> None:
    """One folder per unit; units that ``df`` does not hold keep theirs.

    Units differ in size, so rows stay where they are instead of being shuffled
    into one task per unit.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_snapshot(df: DataFrame, path: str, snapshot_date: str) -> None:
    """End-of-day stock; rewriting a day replaces that day only."""
    (df.withColumn("snapshot_date", F.lit(snapshot_date).cast("date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_date").parquet(path))


def update_batches(changes: DataFrame, size: int = 100, key: str = "id") -> DataFrame:
    """Numbered ``{"update": [...]}`` payloads of at most ``size`` rows, in key order.

    A group collects ``size`` rows and never more.
    """
    fields = F.struct(*changes.columns)
    return (dense_numbers(changes, key)
            .withColumn("batch", F.floor((F.col("rn") - 1) / size).cast("bigint"))
            .groupBy("batch")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.min(key).alias("first_id"),
                 F.max(key).alias("last_id"),
                 F.sort_array(F.collect_list(F.struct(F.col("rn"), fields.alias("row")))).alias("rows"))
            .withColumn("payload", F.to_json(F.struct(F.col("rows.row").alias("update"))))
            .drop("rows"))
