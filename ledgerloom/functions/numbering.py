"""Consecutive numbers 1..n without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.shared import written_once

#: Ranges a numbering is cut into; each holds about this part of the rows.
RANGES = 512
STEP = 16


def _cuts(df: DataFrame, key: str, ranges: int) -> list[int]:
    """At most ``ranges`` - 1 keys that part the rows evenly, whatever gaps the keys have."""
    points = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, points, 10 * ranges)).first()[0]
    return sorted(set(found or []))


def _range_of(key: Column, cuts: list[int]) -> Column:
    """Number of cuts below ``key``, found among every ``STEP``-th cut and then within one step."""
    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c < key))

    if not cuts:
        return F.lit(0)
    steps = [cuts[i:i + STEP] for i in range(0, len(cuts), STEP)]
    coarse = below(F.array(*[F.lit(s[-1]) for s in steps]))
    inside = F.get(F.array(*[F.array(*map(F.lit, s)) for s in steps]), coarse)
    return coarse * STEP + F.coalesce(below(inside), F.lit(0))


def dense_numbers(df: DataFrame, key: str, by: tuple[str, ...] = (),
                  out: str = "rn", ranges: int = RANGES) -> DataFrame:
    """Number the rows of each ``by`` group 1..n in the order of ``key``.

    ``key`` is a unique integer.  Rows are cut into ranges of keys by quantiles,
    so a task sorts about rows / ``ranges`` of them, also where keys lie far
    apart or crowd together.  A range starts after the counts of the ranges
    below it: ``ranges`` numbers for each group, and no more when all rows
    are one group.  The rows are written out once, and cuts, counts and numbers
    all come from what was written, so a recomputed partition numbers identically.
    """
    df = written_once(df)
    ranged = df.withColumn("_bucket", _range_of(F.col(key), _cuts(df, key, ranges)))
    counts = ranged.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    if by:
        before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    else:
        listed = counts.agg(F.collect_list(F.struct("_bucket", "_n")).alias("all"))
        starts = listed.select(F.inline(F.transform("all", lambda x: F.struct(
            x["_bucket"].alias("_bucket"),
            F.aggregate(F.filter("all", lambda y: y["_bucket"] < x["_bucket"]), F.lit(0).cast("bigint"),
                        lambda s, y: s + y["_n"]).alias("_start")))))
    inside = Window.partitionBy(*by, "_bucket").orderBy(key)
    joined = ranged.join(starts, [*by, "_bucket"])
    return (joined.withColumn(out, (F.col("_start") + F.row_number().over(inside)).cast("bigint"))
            .drop("_bucket", "_start"))
