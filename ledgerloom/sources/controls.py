"""Control totals: a report shows only if it adds up to the ledger it was made from.

The rows of the ledger are counted and summed while the report reads them, and
the rows of the report while they are written, so neither is read a second
time.  The report is written aside; a pointer is moved to it once every pair of
totals agrees, and a report that does not agree never shows.  A stage that is
run again after a loss can count rows twice, which refuses a good report rather
than showing a bad one; it can be published again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.streaming.keyed import Files

POINTER = "current.json"


class ControlError(ValueError):
    """The totals of a report and of its ledger differ."""


def _observe(df: DataFrame, totals: dict[str, str]) -> tuple[DataFrame, Observation]:
    watch = Observation(f"totals-{uuid.uuid4().hex}")
    measures = [F.expr(f"coalesce({e}, 0)").alias(n) for n, e in totals.items()]
    return df.observe(watch, F.count(F.lit(1)).alias("n_rows"), *measures), watch


def _totals(watch: Observation, totals: dict[str, str]) -> dict:
    """What was observed; rows that the planner knows to be none are not run, and add up to nothing."""
    try:
        return watch.get
    except Py4JJavaError as unseen:
        if "AssertionError" not in str(unseen):
            raise
        return {"n_rows": 0, **dict.fromkeys(totals, 0)}


@dataclass
class Controlled:
    """A source whose totals are taken while a report reads it; ``totals`` are SQL aggregates by name."""

    source: DataFrame
    totals: dict[str, str]
    rows: DataFrame = field(init=False)
    watch: Observation = field(init=False)

    def __post_init__(self) -> None:
        self.rows, self.watch = _observe(self.source, self.totals)


def publish(report: DataFrame, path: str, totals: dict[str, str], against: Controlled) -> dict:
    """Write a report and show it if its ``totals`` equal those of the same names in ``against``.

    Returns the totals of the report with ``n_rows``.  On a difference what was
    written is taken away, the report shown before stays, and ``ControlError`` is raised.
    """
    spark = report.sparkSession
    files = Files(spark)
    folder = f"run-{uuid.uuid4().hex}"
    watched, watch = _observe(report, totals)
    watched.write.parquet(f"{path}/{folder}")
    own, ledger = _totals(watch, totals), _totals(against.watch, against.totals)
    wrong = {n: (ledger[n], own[n]) for n in totals if n in ledger and ledger[n] != own[n]}
    if wrong:
        files.delete(f"{path}/{folder}")
        raise ControlError("; ".join(f"{n}: {a} in the ledger, {b} in the report" for n, (a, b) in wrong.items()))
    files.write(f"{path}/{POINTER}", json.dumps({"folder": folder, "totals": {n: str(v) for n, v in own.items()}}))
    return own


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The report that was shown last."""
    shown = json.loads(Files(spark).read(f"{path}/{POINTER}"))
    return spark.read.parquet(f"{path}/{shown['folder']}")


def drop_hidden(spark: SparkSession, path: str) -> int:
    """Delete the runs that are not shown (older ones, and what a lost driver left); how many went."""
    files = Files(spark)
    shown = json.loads(files.read(f"{path}/{POINTER}"))["folder"] if files.exists(f"{path}/{POINTER}") else None
    hidden = [n for n in files.names(path) if n.startswith("run-") and n != shown]
    for name in hidden:
        files.delete(f"{path}/{name}")
    return len(hidden)
