"""Which receipt was sold: units leave an item's stock in the order they came in.

Laid end to end, the units that came in occupy intervals of a line of numbers,
and so do those that went out; unit k out is unit k in, so a receipt supplied an
issue as far as their intervals overlap.  No receipt is paired with every later
sale: the ends of all intervals, in order, cut the line into pieces that belong
to one receipt and one issue each.

An item may hold half of all movements.  Its running totals are summed by day
first, and its line of numbers is dealt out in ranges, so that no task has more
than a day's lines or a range's pieces of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import signed_qty
from ledgerloom.operators.stock import KEY, MOVEMENT_ORDER

IN, OUT = "in", "out"
#: Movements of an item that share a range of its units.
PER_RANGE = 50_000
UNITS = "decimal(38,2)"
LINE = ["xdate", "xdocnum", "xline", "xsup"]


def _placed(moves: DataFrame, per_range: int) -> DataFrame:
    """Movements with their interval of units [``since``, ``upto``) and the ``width`` of a range of their item."""
    lines = moves.withColumn("units", signed_qty()).where("units <> 0").selectExpr(
        *KEY, *MOVEMENT_ORDER, f"IF(units > 0, '{IN}', '{OUT}') AS side", f"cast(abs(units) AS {UNITS}) AS units")
    daily = lines.groupBy(*KEY, "side", "xdate").agg(F.sum("units").cast(UNITS).alias("day_units"), F.count(F.lit(1)).alias("n"))
    days = Window.partitionBy(*KEY, "side").orderBy("xdate").rowsBetween(Window.unboundedPreceding, -1)
    of_side, of_item = Window.partitionBy(*KEY, "side"), Window.partitionBy(*KEY)
    offsets = (daily.withColumn("before", F.coalesce(F.sum("day_units").over(days), F.lit(0)).cast(UNITS))
               .withColumn("whole", F.sum("day_units").over(of_side))
               .select(*KEY, "side", "xdate", "before", F.max("whole").over(of_item).alias("whole"),
                       F.ceil(F.sum("n").over(of_item) / per_range).alias("ranges")))
    width = F.greatest(F.lit(1), F.ceil(F.col("whole") / F.col("ranges"))).cast(UNITS)
    in_day = Window.partitionBy(*KEY, "side", "xdate").orderBy(*MOVEMENT_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    upto = (F.col("before") + F.col("in_day")).cast(UNITS)
    return (lines.withColumn("in_day", F.sum("units").over(in_day))
            .join(offsets.withColumn("width", width).drop("whole", "ranges"), [*KEY, "side", "xdate"])
            .withColumn("upto", upto).withColumn("since", (F.col("upto") - F.col("units")).cast(UNITS))
            .drop("in_day", "before"))


def fifo_matches(moves: DataFrame, per_range: int = PER_RANGE) -> DataFrame:
    """(zid, xitem, ``came``, ``went``, units): units of an incoming movement that left with an outgoing one.

    ``came`` and ``went`` hold date, document, line and supplier.  Units that
    are still there have a NULL ``went``; units that left without ever having
    come in a NULL ``came``.  A negative receipt takes units out and a negative
    sale brings some in.  A pair may have several rows, whose units add up:
    one for each range that it reaches into.
    """
    placed = _placed(moves, per_range)
    # Whole quotients: a rounded one would put the end of a range into the next.
    first, last = F.expr("since div width"), F.expr("(upto - 0.01BD) div width")
    spread = placed.withColumn("range", F.explode(F.sequence(first, last)))
    start = (F.col("range") * F.col("width")).cast(UNITS)
    end = F.least("upto", ((F.col("range") + 1) * F.col("width")).cast(UNITS))

    def of(side: str) -> Column:
        return F.when(F.col("side") == side, F.struct(*LINE)).alias(side)

    ends = spread.select(*KEY, "range", start.alias("start"), end.alias("end"), of(IN), of(OUT))
    # From the last end down, so that the interval over a piece is the latest end seen, in one step a row.  On one side at
    # most one interval ends at a place; of two ends there the first gives a piece of no units and the second has seen both.
    down = Window.partitionBy(*KEY, "range").orderBy(F.desc("end"))
    above = down.rowsBetween(Window.unboundedPreceding, 0)
    pieces = ends.select(
        *KEY, F.last(IN, ignorenulls=True).over(above).alias("came"), F.last(OUT, ignorenulls=True).over(above).alias("went"),
        (F.col("end") - F.coalesce(F.lead("end").over(down), F.col("start"))).cast(UNITS).alias("units"))
    return pieces.where("units > 0")


def receipt_sales(moves: DataFrame, receipts: str = "GRN-", sales: str = "CO--", per_range: int = PER_RANGE) -> DataFrame:
    """What became of each receipt of an item: units received, sold, gone otherwise and left, each counted once.

    ``unit_days`` adds up the days from the receipt to the sale over the units
    sold; it is negative where goods were sold before they came in.
    """
    matched = fifo_matches(moves, per_range).where(F.col("came.xdocnum").startswith(receipts))
    sold = F.coalesce(F.col("went.xdocnum").startswith(sales), F.lit(False))
    gone = F.col("went").isNotNull() & ~sold
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("units"))), F.lit(0)).cast(UNITS)
    days = F.datediff("went.xdate", "came.xdate")
    return matched.groupBy(*KEY, F.col("came.xdocnum").alias("xgrnnum"), F.col("came.xdate").alias("received_on")).agg(
        F.sum("units").cast(UNITS).alias("received"), total(sold).alias("sold"), total(gone).alias("gone"),
        total(F.col("went").isNull()).alias("left"),
        F.coalesce(F.sum(F.when(sold, F.col("units") * days)), F.lit(0)).cast(UNITS).alias("unit_days"))


def stock_layers(moves: DataFrame, per_range: int = PER_RANGE) -> DataFrame:
    """The units on hand by the day they came in, and as negative units those that went without having come."""
    open_ends = fifo_matches(moves, per_range).where("came IS NULL OR went IS NULL")
    units = F.when(F.col("went").isNull(), F.col("units")).otherwise(-F.col("units"))
    return open_ends.groupBy(*KEY, F.coalesce("came.xdate", "went.xdate").alias("since"), F.col("came").isNull().alias("missing")).agg(
        F.sum(units).cast(UNITS).alias("units"))
