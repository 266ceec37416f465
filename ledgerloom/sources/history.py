"""History as validity intervals: a value is stored when it changes, not once a day.

An interval says that a key had its values from a day until, but not on, another;
the last one is open.  Open intervals lie in buckets of keys, of which a day
rewrites those it changes; closed ones are only added to.  Any past day is the
intervals that hold it, so storage grows with the changes.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import day, signed_qty
from ledgerloom.streaming.keyed import ARCHIVE, LIVE, KeyedState


def stock_intervals(moves: DataFrame, keys: tuple[str, ...] = ("zid", "xitem")) -> DataFrame:
    """(keys, inventory, valid_from, valid_to) of every balance an item ever had.

    Movements are summed by day first, so the window of an item holds a row per
    calendar day at most.  A day whose movements cancel out opens no interval.
    """
    daily = moves.groupBy(*keys, "xdate").agg(F.sum(signed_qty()).alias("change")).where("change <> 0")
    of_item = Window.partitionBy(*keys).orderBy("xdate")
    return daily.select(
        *keys, F.sum("change").over(of_item.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(38,2)").alias("inventory"),
        F.col("xdate").alias("valid_from"), F.lead("xdate").over(of_item).alias("valid_to"))


class History(KeyedState):
    """Intervals of ``values`` (a DDL string) under ``keys``.

    Days are given in order, each under a batch of its own; the last day may be
    given again and replaces what it brought.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: str, values: str, **layout) -> None:
        names = [f.strip().split()[0] for f in keys.split(",")]
        super().__init__(spark, folder, f"{keys}, {values}, valid_from date, valid_to date", names, **layout)
        columns = [f.name for f in spark.createDataFrame([], self.schema).schema]
        self.values = columns[len(names):-2]

    def _last(self) -> int:
        return max(int(n.removesuffix(".json")) for n in self.files.names(f"{self.folder}/manifest") if n.endswith(".json"))

    def load(self, intervals: DataFrame, upto: date) -> None:
        """Start with the intervals of everything up to a day."""
        self.open(notes={"days": {}})
        every = list(range(self.buckets))
        placed = intervals.withColumn("area", F.when(F.col("valid_to").isNull(), LIVE).otherwise(ARCHIVE))
        self.write(0, placed, every, {"days": {"0": str(upto)}})

    def close_day(self, on: date, snapshot: DataFrame) -> None:
        """Take the end-of-day values of all keys; a key that is not in it has no value any more."""
        batch, days = self._batch_of(on)
        known = self.read(batch - 1, LIVE).select(*self.keys, *[F.col(v).alias(f"__{v}") for v in self.values], F.lit(True).alias("__known"))
        joined = snapshot.select(*self.keys, *self.values, F.lit(True).alias("__given")).join(known, self.keys, "full")
        same = F.col("__given").eqNullSafe(F.col("__known"))
        for v in self.values:
            same = same & F.col(v).eqNullSafe(F.col(f"__{v}"))
        self._apply(batch, days, on, joined.where(~same).select(*self.keys, *self.values, F.col("__given").isNotNull().alias("__given")))

    def apply_changes(self, on: date, changed: DataFrame) -> None:
        """Take the values of the keys that changed on a day; only their buckets are opened."""
        batch, days = self._batch_of(on)
        self._apply(batch, days, on, changed.select(*self.keys, *self.values, F.lit(True).alias("__given")))

    def _batch_of(self, on: date) -> tuple[int, dict]:
        if not self.files.exists(self._manifest_path(-1)):
            self.open(notes={"days": {}})
        last = self._last()
        days = self.manifest(last)["notes"]["days"]
        newest = days.get(str(last))
        if newest is not None and str(on) < newest:
            raise ValueError(f"{on} is before {newest}, the last day taken")
        batch = last if str(on) == newest else last + 1
        return batch, {**{k: d for k, d in days.items() if int(k) < batch}, str(batch): str(on)}

    def _apply(self, batch: int, days: dict, on: date, changed: DataFrame) -> None:
        changed = changed.persist()
        met = [r.bucket for r in changed.select(self.bucket().alias("bucket")).distinct().collect()]
        held = self.read(batch - 1, LIVE, met)
        touched = held.join(changed.select(*self.keys, F.lit(True).alias("__touched")), self.keys, "left")
        columns = [*self.keys, *self.values, "valid_from", "valid_to"]
        kept = touched.select(*columns, F.lit(LIVE).alias("area")).where("__touched IS NULL")
        closed = touched.where("__touched").withColumn("valid_to", day(on)).select(*columns, F.lit(ARCHIVE).alias("area"))
        fresh = changed.where("__given").select(*self.keys, *self.values, day(on).alias("valid_from"),
                                                F.lit(None).cast("date").alias("valid_to"), F.lit(LIVE).alias("area"))
        self.write(batch, kept.unionByName(closed).unionByName(fresh), met, {"days": days})
        changed.unpersist()

    def as_of(self, on: date) -> DataFrame:
        """(keys, values) at the end of a day; closed files of days up to it are not opened."""
        last = self._last()
        found = self.manifest(last)
        days = {int(k): d for k, d in found["notes"]["days"].items()}
        first = min(days, default=0)
        filed = [(part, ARCHIVE, k) for k, parts in found["areas"].get(ARCHIVE, {}).items() for part in parts
                 if part == first or days[part] > str(on)]
        holds = (F.col("valid_from") <= day(on)) & (F.col("valid_to").isNull() | (F.col("valid_to") > day(on)))
        return self.read(last, LIVE).unionByName(self._read(filed)).where(holds).select(*self.keys, *self.values)
