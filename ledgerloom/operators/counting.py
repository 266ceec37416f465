"""Cycle counting: which items to count, and on which days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import day, seeded_hash, signed_qty, signed_value
from ledgerloom.model import Model
from ledgerloom.operators.stock import KEY

POOL_SIZE, PICKS = 200, 3
DAYS_OFF = ("Friday",)


def first_per_unit(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows of each unit.  The rank filter is applied within every
    task before the shuffle, so only n rows per task and unit move."""
    rank = F.row_number().over(Window.partitionBy("zid").orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def count_pool(m: Model, counted: DataFrame, n: int = POOL_SIZE) -> DataFrame:
    """The n most valuable stocks of each unit not yet counted this quarter."""
    stock = m.imtrn.groupBy(*KEY, "xwh").agg(
        F.sum(signed_qty()).alias("stockqty"), F.sum(signed_value()).alias("stockvalue"))
    fresh = stock.join(counted.select(*KEY).distinct(), KEY, "left_anti")
    named = fresh.join(m.caitem.select(*KEY, "xdesc", "xgitem"), KEY)
    return first_per_unit(named, n, F.desc("stockvalue"), "xitem", "xwh")


def count_picks(pool: DataFrame, k: int = PICKS, seed: int = 0, units: DataFrame | None = None) -> DataFrame:
    """k rows of each unit, or of each of the chosen ``units``, drawn without replacement.

    The chance follows the stock value, negative values counting as 0: with
    u uniform and w the weight, the k smallest ``-ln(u) / w`` are such a draw.
    Rows of weight 0 come after all others in a uniform order, so they are
    drawn only when nothing of value is left.
    """
    bits = seeded_hash(seed, F.col("zid"), F.col("xitem"), F.col("xwh"))
    if units is not None:
        pool = pool.join(units.select("zid"), "zid", "left_semi")
    u = (bits + 1).cast("double") / F.lit(2.0 ** 32 + 1)
    weight = F.greatest(F.col("stockvalue"), F.lit(0)).cast("double")
    keyed = pool.withColumns({"_bits": bits, "_key": F.try_divide(-F.log(u), weight)})
    return first_per_unit(keyed, k, F.asc_nulls_last("_key"), "_bits", "xitem", "xwh").drop("_bits", "_key")


def count_history(history: DataFrame, picks: DataFrame, on: date) -> DataFrame:
    """Items counted in the quarter of ``on``, with the new picks."""
    quarter = F.trunc(day(on), "quarter")
    before = history.filter(F.col("quarter_start") == quarter).select("quarter_start", *KEY)
    return before.union(picks.select(quarter.alias("quarter_start"), *KEY)).distinct()


def choose_units(pool: DataFrame, k: int = 1, seed: int = 0) -> DataFrame:
    """k units drawn evenly among those that have something to count."""
    return (pool.select("zid").distinct()
            .orderBy(seeded_hash(seed, F.lit("unit"), F.col("zid")), "zid").limit(k))


def working_days(calendar: DataFrame, days_off: tuple[str, ...] = DAYS_OFF,
                 holidays: list[date] | None = None) -> DataFrame:
    """Distinct calendar days on which the job may run."""
    weekday = F.date_format("xdate", "EEEE")
    free = [day(h) for h in holidays or []]
    days = calendar.select("xdate").distinct().withColumn("weekday", weekday)
    open_days = days.filter(~F.col("weekday").isin(*days_off)) if days_off else days
    return open_days.filter(~F.col("xdate").isin(*free)) if free else open_days
