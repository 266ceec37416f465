"""As-of totals without the full history: a ledger by period with sums of each period beside it.

A batch of ledger rows is written by period, and with it the sums of its rows
by key and period and by key and year.  Sums add up, so a row dated back into a
closed period is a correction that its batch brings along; nothing written
before is touched.  A balance as of a day is the sum of the years before, of
the periods before in its year, and of the rows of one period up to the day.
The manifest names a batch once its rows and sums are complete; a batch that is
run again replaces its own.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import day
from ledgerloom.streaming.keyed import Files

#: ``period`` of a row is year * 100 + its number in the year; 0 is the opening.
YEAR, PERIOD = "year", "period"


class PeriodLedger:
    """``keys`` are summed by; ``measures`` are SQL expressions that add up, under the name of their sum."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], measures: dict[str, str], period: str = "xyear * 100 + xper") -> None:
        self.spark, self.folder, self.keys, self.measures, self.period = spark, folder, keys, measures, period
        self.files = Files(spark)

    def _manifest(self) -> dict:
        path = f"{self.folder}/manifest.json"
        return json.loads(self.files.read(path)) if self.files.exists(path) else {"rows": [], "sums": []}

    # --- writing

    def add(self, rows: DataFrame, batch: int) -> None:
        """Add the rows of one batch, whatever periods they belong to."""
        target = f"{self.folder}/batch={batch}"
        # A period's rows go to few files, and a large period to several tasks.
        (rows.withColumn("period", F.expr(f"cast({self.period} AS int)")).hint("rebalance", "period")
         .write.mode("overwrite").partitionBy("period").parquet(f"{target}/rows"))
        written = self.spark.read.parquet(f"{target}/rows")
        by_period = written.groupBy(*self.keys, "period").agg(*[F.expr(f"sum({e})").alias(n) for n, e in self.measures.items()])
        self._write_sums(by_period, f"{target}/sums")
        found = self._manifest()
        if batch not in found["rows"]:
            found["rows"].append(batch)
            found["sums"].append(f"batch={batch}/sums")
        self.files.write(f"{self.folder}/manifest.json", json.dumps(found))

    def _write_sums(self, by_period: DataFrame, target: str) -> None:
        """Sums of both levels from one row per key and period; those of years come from the written sums of periods."""
        at = {PERIOD: F.col("period"), YEAR: F.floor(F.col("period") / 100).cast("int")}
        wide = [F.col(n).cast("decimal(38,2)").alias(n) for n in self.measures]
        # Sorted, so that the files' statistics tell which periods they hold.
        (by_period.select(*self.keys, at[PERIOD].alias("at"), *wide).sortWithinPartitions("at")
         .write.mode("overwrite").parquet(f"{target}/level={PERIOD}"))
        written = self.spark.read.parquet(f"{target}/level={PERIOD}").withColumnRenamed("at", "period")
        (written.groupBy(*self.keys, at[YEAR].alias("at")).agg(*[F.sum(n).cast("decimal(38,2)").alias(n) for n in self.measures])
         .sortWithinPartitions("at").write.mode("overwrite").parquet(f"{target}/level={YEAR}"))

    def merge(self) -> None:
        """Put the sums of all batches together, so that a reader opens few files and not some of every batch."""
        found = self._manifest()
        if len(found["sums"]) < 2:
            return
        target = f"merged={max(found['rows'])}/sums"
        self._write_sums(self.by_period(), f"{self.folder}/{target}")
        self.files.write(f"{self.folder}/manifest.json", json.dumps({**found, "sums": [target]}))

    # --- reading

    def rows(self) -> DataFrame:
        """All rows, with their ``period``; a test of it chooses folders."""
        parts = [self.spark.read.parquet(f"{self.folder}/batch={b}/rows") for b in self._manifest()["rows"]]
        return _all(parts)

    def sums(self, level: str = PERIOD) -> DataFrame:
        """(keys, at, measures) of all batches: the sums of periods or of years."""
        parts = [self.spark.read.parquet(f"{self.folder}/{p}") for p in self._manifest()["sums"]]
        found = _all(parts).where(F.col("level") == level)
        return found.select(*self.keys, "at", *self.measures)

    def by_period(self, upto: int | None = None) -> DataFrame:
        """One row per key and period, of periods up to ``upto``; no ledger row is read."""
        sums = self.sums(PERIOD) if upto is None else self.sums(PERIOD).where(F.col("at") <= upto)
        return sums.groupBy(*self.keys, F.col("at").alias("period")).agg(*[F.sum(n).cast("decimal(38,2)").alias(n) for n in self.measures])

    def as_of(self, on: date, only: Column | None = None, dated: str = "xdate") -> DataFrame:
        """Sums by key over all rows up to a day, for periods that are calendar months.

        Whole years come from the sums of years, months before the day's from
        those of periods; of the ledger only the day's own month is read.
        """
        month = on.year * 100 + on.month
        years = self.sums(YEAR).where(F.col("at") < on.year)
        months = self.sums(PERIOD).where((F.col("at") >= on.year * 100) & (F.col("at") < month))
        tail = self.rows().where((F.col("period") == month) & (F.col(dated) <= day(on)))
        wide = [F.col(n).cast("decimal(38,2)").alias(n) for n in self.measures]
        parts = [years.select(*self.keys, *wide), months.select(*self.keys, *wide),
                 tail.select(*self.keys, *[F.expr(f"cast({e} AS decimal(38,2))").alias(n) for n, e in self.measures.items()])]
        every = _all(parts)
        every = every if only is None else every.where(only)
        return every.groupBy(*self.keys).agg(*[F.sum(n).cast("decimal(38,2)").alias(n) for n in self.measures])


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
