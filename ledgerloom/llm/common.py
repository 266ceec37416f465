"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.shared import new_folder, shared_dir

#: ASCII white space as the contracts count it; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Bytes of an Arrow batch that goes to a Python worker.
ARROW_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character kept, so that lengths never change."""
    return F.translate(text, UPPER, LOWER)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the folder named in ``spark.checkpoint.dir`` and read it back.

    A lost executor then costs a read and no recomputation.  A local session
    without the setting (tests) gets a folder of its own, a cluster is refused.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def write_in_order(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back; ``with_place`` finds its order again."""
    path = new_folder(df.sparkSession, "ordered")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_place(df: DataFrame, into: str) -> DataFrame:
    """``df`` with ``into``, the place from 0 of each row in the order it was written in.

    A written table has one file or more per task, named by the task's number,
    and readers deal files out by size; so the place is told by file name and
    row index.  Anything not read from files has its rows in the order of its
    partitions.  One count per file goes to the driver.
    """
    file, split, row = "__file", "__split", "__row"
    try:
        name = F.col("_metadata.file_name")
        part = lambda pattern: F.coalesce(F.regexp_extract(name, pattern, 1).try_cast("long"), F.lit(0))
        rows = df.select("*", part(r"^part-(\d+)").alias(file), part(r"-c(\d+)").alias(split), F.col("_metadata.row_index").alias(row))
    except AnalysisException:
        number = F.monotonically_increasing_id()
        rows = df.select("*", F.shiftright(number, 33).alias(file), F.lit(0).cast("long").alias(split),
                         number.bitwiseAND(F.lit((1 << 33) - 1)).alias(row))
    starts, total = [], 0
    for r in sorted(rows.groupBy(file, split).count().collect()):
        starts.append((r[0], r[1], total))
        total += r[2]
    starts = df.sparkSession.createDataFrame(starts, f"{file} long, {split} long, __start long")
    return rows.join(F.broadcast(starts), [file, split]).withColumn(into, F.col("__start") + F.col(row)).drop(
        file, split, row, "__start")


def _bytes(size: str) -> int:
    """Bytes of a size setting; a negative one means no limit."""
    digits = size.strip().lower().rstrip("bkmgt")
    unit = size.strip().lower()[len(digits):].rstrip("b") or "b"
    number = int(digits) * 1024 ** "bkmgt".index(unit)
    return number if number >= 0 else 1 << 62


def ship(spark: SparkSession) -> None:
    """Prepare the Python workers: this package, wherever the session was started from, and small Arrow batches.

    A worker holds a batch several times over, as bytes and as objects, so
    batches beyond ``ARROW_BYTES`` only cost memory.
    """
    context = spark.sparkContext
    if _bytes(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "64m")) > _bytes(ARROW_BYTES):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    package = Path(__file__).resolve().parent.parent
    if getattr(context, "_ledgerloom_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-code-"), "ledgerloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(archive)
    context._ledgerloom_shipped = True


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Numbering(dict):
    """Numbers things from 0 as they are first asked for; ``fresh`` holds those not yet taken."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, thing):
        number = self[thing] = len(self)
        self.fresh.append(thing)
        return number

    def take(self) -> list:
        fresh, self.fresh = self.fresh, []
        return fresh
