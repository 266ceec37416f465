"""Mixing sources to target weights by Pfair scheduling of blocks.

The documents of a source are cut into blocks, and every slot takes one block.
While sources have blocks left they share the slots in proportion to their
weights; when one runs out the others share its slots.  So block i (from 0) of
a source of weight w would be served between the times t(i / w) and
t((i + 1) / w), where t(v) is the sum of min(blocks, v * weight) over all
sources.  It is released at the floor of the first, due by the ceiling of the
second, and each slot goes to the released block of the earliest deadline.  So
at any time a source has received less than one block more or less than its
share.  Weights are taken as exact fractions: nothing is rounded to a period.

Tasks lay out segments of the schedule, and each finds its own start
(``Fluid.state``): what the one schedule has served before a slot follows from
the ideal service there and from the slots since the oldest block then open.
The driver holds a few numbers per source and no block.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import accumulate, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship, table

#: Documents of a block, and slots of a segment at least.
BLOCK, SEGMENT = 8, 10_000
#: Slots that leave a task in one batch, and tasks that lay the segments out at most.
BATCH, TASKS = 10_000, 10_000
#: A segment is at least this part of the longest time a block stays open, which is what finding its start can take.
WARM_UP = 4
#: Without given weights a source weighs its documents to this power.
TEMPERATURE = 0.5
#: Documents that one window numbers, about.
SLICE_ROWS = 4_000
OTHERS = "\u0000others"
ADDED = ("mix_block", "mix_slot", "mix_place", "mix_release", "mix_deadline")


class Fluid:
    """The ideal service: when each block would be served if slots could be shared."""

    def __init__(self, blocks: Sequence[int], weights: Sequence[int]) -> None:
        self.blocks, self.weights = blocks, weights
        ends = sorted((Fraction(c, w), c, w) for c, w in zip(blocks, weights, strict=True))
        self.ends = [e[0] for e in ends]
        self.done = [0, *accumulate(e[1] for e in ends)]  # blocks of the sources that have run out
        rest = [0, *accumulate(e[2] for e in reversed(ends))][::-1]  # weight of those that have not
        self.active = rest[:-1]
        self.times = [d + a * e for d, a, e in zip(self.done, self.active, self.ends)]  # when they run out

    def around(self, source: int, block: int) -> tuple[int, int]:
        """Floor and ceiling of the time at which a block would begin and the one before would end."""
        w = self.weights[source]
        k = bisect_left(self.ends, Fraction(block, w))
        exact = self.active[k] * block
        return self.done[k] + exact // w, self.done[k] - (-exact // w)

    def ideal(self, time: int) -> tuple[int, int]:
        """The ideal service up to a time, as numerator and denominator of blocks per weight."""
        k = bisect_left(self.times, time)
        return (time - self.done[k], self.active[k]) if k < len(self.times) else (self.ends[-1].numerator, self.ends[-1].denominator)

    def longest(self) -> int:
        """Slots that no block stays open longer than; the time is flattest in the service at the beginning."""
        return max(self.around(s, 1)[1] for s in range(len(self.blocks)))

    def state(self, time: int) -> list[int]:
        """Blocks of every source that the schedule has served before a slot, without running through it.

        Blocks due by then are served, and blocks not begun in the ideal are
        not released.  At most one block of a source is open between, and such
        blocks have got the slots that those due left idle, by deadline.  No
        open block was released before the oldest of them; all that was
        released before that is due, and every slot was taken, so the queue at
        that moment is known.  From there on its idle slots are counted.
        """
        served, per = self.ideal(time)
        done, opened = [], []
        for s, (c, w) in enumerate(zip(self.blocks, self.weights, strict=True)):
            done.append(min(c, w * served // per))
            if done[s] < c and w * served % per:
                opened.append((self.around(s, done[s])[0], self.around(s, done[s] + 1)[1], s))
        idle = time - sum(done)
        if not idle:
            return done
        heapq.heapify(opened)
        slot = opened[0][0]
        served, per = self.ideal(slot)
        begun = [min(c, -(-w * served // per)) for c, w in zip(self.blocks, self.weights, strict=True)]
        queue = sum(begun) - slot
        arriving = [(self.around(s, i)[0], s, i) for s, i in enumerate(begun) if i < done[s]]
        heapq.heapify(arriving)
        ready, due = [], list(done)
        while idle:
            while arriving and arriving[0][0] <= slot:
                _, s, i = arriving[0]
                queue += 1
                if i + 1 < due[s]:
                    heapq.heapreplace(arriving, (self.around(s, i + 1)[0], s, i + 1))
                else:
                    heapq.heappop(arriving)
            while opened and opened[0][0] <= slot:
                _, deadline, s = heapq.heappop(opened)
                heapq.heappush(ready, (deadline, s))
            if queue:
                queue -= 1
            else:
                done[heapq.heappop(ready)[1]] += 1
                idle -= 1
            slot += 1
        return done

    def serve(self, done: Sequence[int], first: int, last: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(slot, source, block, release, deadline) of the slots from ``first``, where ``done`` blocks have been served."""
        waiting, ready = [], []  # a source's next block is released with or after the slot of the one before
        for s, i in enumerate(done):
            if i < self.blocks[s]:
                waiting.append((self.around(s, i)[0], s, i))
        heapq.heapify(waiting)
        for slot in range(first, last):
            while waiting and waiting[0][0] <= slot:
                release, s, i = heapq.heappop(waiting)
                following, deadline = self.around(s, i + 1)
                heapq.heappush(ready, (deadline, s, i, release, following))
            deadline, s, i, release, following = heapq.heappop(ready)
            yield slot, s, i, release, deadline
            if i + 1 < self.blocks[s]:
                heapq.heappush(waiting, (following, s, i + 1))


def whole(weights: Sequence[float]) -> list[int]:
    """Whole numbers in exactly the proportion of the weights."""
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*(w.denominator for w in exact))
    return [int(w * scale) for w in exact]


def _schedule(spark: SparkSession, blocks: Mapping[str, int], weights: Mapping[str, float]) -> DataFrame:
    """(__source, mix_block, mix_slot, mix_release, mix_deadline), one row per block."""
    names = sorted(n for n, c in blocks.items() if c > 0)
    fluid = Fluid([blocks[n] for n in names], whole([weights[n] for n in names]))
    total = sum(fluid.blocks)
    span = max(SEGMENT, len(names), -(-fluid.longest() // WARM_UP)) if names else SEGMENT
    ship(spark)
    known = spark.sparkContext.broadcast((names, fluid))
    columns = ["mix_slot", "__source", "mix_block", "mix_release", "mix_deadline"]

    def lay_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, fluid = known.value
        for batch in batches:
            for first in batch["id"].tolist():
                slots = fluid.serve(fluid.state(first), first, min(first + span, total))
                while rows := list(islice(slots, BATCH)):
                    out = pd.DataFrame(rows, columns=columns)
                    yield out.assign(__source=[names[s] for s in out["__source"]])[["__source", "mix_block", "mix_slot", "mix_release", "mix_deadline"]]

    segments = spark.range(0, total, span, max(1, min(-(-total // span), TASKS)))
    return segments.mapInPandas(lay_out, "__source string, mix_block long, mix_slot long, mix_release long, mix_deadline long")


def _numbered(docs: DataFrame, source: Column, key: Column) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``__source``, ``__slice`` and ``__rank``, from 1 in hash order; and the slices with ``__start`` and ``count``.

    A source is numbered slice by slice: a slice is a range of hashes, and the
    counts of the slices before it tell where it begins.  A source with a third
    of all rows is spread over as many windows as its rows need.
    """
    rows = docs.withColumn("__source", source).withColumn("__hash", key)
    total = docs.count()
    slices = max(1, -(-total // SLICE_ROWS))
    rows = rows.withColumn("__slice", F.floor(F.shiftrightunsigned("__hash", 24) / (float(1 << 40) / slices)).cast("int"))
    counts = rows.groupBy("__source", "__slice").count()
    before = Window.partitionBy("__source").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per source and slice; a source has as many as the corpus has slices.
    starts = counts.withColumn("__start", F.coalesce(F.sum("count").over(before), F.lit(0)))
    order = Window.partitionBy("__source", "__slice").orderBy("__hash")
    return rows.withColumn("__rank", F.row_number().over(order)), starts


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, source: str = "source",
                block: int = BLOCK, into: str | None = None) -> DataFrame:
    """``docs`` with ``mix_block``, ``mix_slot``, ``mix_place``, ``mix_release`` and ``mix_deadline``.

    With ``into`` they are fields of one column of that name.

    Rows in order of (mix_slot, mix_place) are the mix.  Without weights every
    source weighs the square root of its documents.  ``weights`` name any number
    of sources; those not named share the weight named ``OTHERS`` (1 without
    it).  No row is dropped or repeated: a source that has run out leaves its
    slots to the others.  A null source counts as the empty one; rows of a
    source are placed by a hash of all their columns, so null and repeated ids
    are spread like others; an empty table stays empty; columns of exactly the
    added names are replaced, all others stay.
    """
    docs = docs.drop(*([into] if into else ADDED))
    hashed = F.xxhash64(*[F.col(f"`{n}`") for n, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    # The row travels as one value, so that its columns meet none of the helpers'.
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"),
                       F.coalesce(F.col(source), F.lit("")).alias("__own"), hashed.alias("__key"))
    if weights is None:
        docs = docs.withColumn("__share", F.col("__own"))
    else:
        if min(weights.values(), default=1) <= 0:
            raise ValueError("give every source a weight above 0")
        known = docs.sparkSession.createDataFrame([(n,) for n in weights if n != OTHERS], "__known string")
        docs = docs.join(F.broadcast(known), F.col("__own") == F.col("__known"), "left").withColumn(
            "__share", F.coalesce("__known", F.lit(OTHERS))).drop("__known")
    share = F.col("__share")
    # One row per source, whatever the documents.
    counts = {r["s"]: r["count"] for r in docs.groupBy(share.alias("s")).count().collect()}
    named = {n: (float(c) ** TEMPERATURE if weights is None else float(weights.get(n, 1.0))) for n, c in counts.items()}
    schedule = _schedule(docs.sparkSession, {n: -(-c // block) for n, c in counts.items()}, named)
    rows, starts = _numbered(docs, share, F.col("__key"))
    # A slice takes the places of its own blocks along, so documents meet the schedule where they were numbered.
    first, last = F.floor(F.col("__start") / block), F.floor((F.col("__start") + F.col("count") - 1) / block)
    slices = starts.select("__source", "__slice", "__start", F.explode(F.sequence(first, last)).alias("mix_block"))
    # Spark takes the schedule for as small as the segments it is made from and would broadcast it at any size.
    slices = slices.join(schedule.hint("merge"), ["__source", "mix_block"]).groupBy("__source", "__slice", "__start").agg(
        F.array_sort(F.collect_list(F.struct("mix_block", "mix_slot", "mix_release", "mix_deadline"))).alias("__places"))
    number = F.col("__start") + F.col("__rank") - 1
    at = F.element_at("__places", (F.floor(number / block) - first + 1).cast("int"))
    placed = rows.join(slices, ["__source", "__slice"]).select("__doc", at.alias("__at"), (number % block).alias("mix_place"))
    added = [F.col(c if c == "mix_place" else f"__at.{c}").alias(c) for c in ADDED]
    return placed.select("__doc.*", *([F.struct(*added).alias(into)] if into else added))


def op8_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))


QUERIES = {"op8_pfair_mix": op8_pfair_mix}
ORACLES: dict[str, str] = {}
