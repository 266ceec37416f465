"""First in, first out: every unit is matched once, however the work is dealt out."""

import random
from collections import defaultdict

import pytest
from conftest import move, n, rows
from pyspark.sql import functions as F

from ledgerloom.operators import fifo, stock


def plain(moves):
    """Units one after the other."""
    out = defaultdict(int)
    items = defaultdict(lambda: ([], []))
    for m in sorted(moves, key=lambda m: (m["xdate"], m["xdocnum"], m["xline"], m["xsup"], m["xqty"], m["xval"])):
        q = int(m["xqty"]) * m["xsign"]
        items[m["xitem"]][q < 0].extend([m["xdocnum"]] * abs(q))
    for item, (came, went) in items.items():
        for k in range(max(len(came), len(went))):
            out[item, came[k] if k < len(came) else None, went[k] if k < len(went) else None] += 1
    return dict(out)


def found(df):
    got = df.groupBy("xitem", F.col("came.xdocnum").alias("came"), F.col("went.xdocnum").alias("went")).agg(F.sum("units").alias("u"))
    return {(r.xitem, r.came, r.went): int(r.u) for r in got.collect()}


def some_moves(seed, items, count):
    rng = random.Random(seed)
    return [move(item=f"I{rng.randrange(items)}", on=f"2024-0{rng.randint(1, 3)}-{rng.randint(1, 28):02d}",
                 doc=f"{rng.choice(['GRN-', 'CO--', 'TO--', 'SRE-'])}{k:03d}", qty=rng.choice([-2, 0, 1, 3, 7, 12]), line=rng.randint(1, 2))
            for k in range(count)]


@pytest.mark.parametrize("per_range", [1, 3, 50_000])
def test_matches_of_random_movements(spark, table, per_range):
    moves = some_moves(per_range, 3, 90)
    got = fifo.fifo_matches(table("imtrn", *moves), per_range)
    assert found(got) == plain(moves)
    if per_range > 90:  # no range cut any pair
        assert got.count() == got.select("xitem", "came", "went").distinct().count()


def test_units_add_up_to_the_ledger(sample):
    got = fifo.fifo_matches(sample.imtrn, 2)
    for column, sign in (("came", ">"), ("went", "<")):
        matched = got.where(f"{column} IS NOT NULL").groupBy(*stock.KEY).agg(F.sum("units").alias("u"))
        ledger = sample.imtrn.groupBy(*stock.KEY).agg(
            F.expr(f"sum(abs(xqty)) FILTER (WHERE xqty * xsign {sign} 0)").cast("decimal(38,2)").alias("u")).where("u IS NOT NULL")
        assert rows(matched, *stock.KEY, "u") == rows(ledger, *stock.KEY, "u")
    layers = fifo.stock_layers(sample.imtrn).groupBy(*stock.KEY).agg(F.sum("units").alias("inventory")).where("inventory <> 0")
    balance = stock.inventory_balance(sample).select(*stock.KEY, "inventory").where("inventory <> 0")
    assert rows(layers) == rows(balance)


def test_an_item_with_half_of_all_rows_is_spread(spark, sample):
    """One item takes half of the movements: no group of the last step has more than its range."""
    hot = sample.imtrn.withColumn("xitem", F.when(F.crc32("xdocnum") % 2 == 0, F.lit("HOT")).otherwise(F.col("xitem"))).withColumn("zid", F.lit(1))
    rows_of_hot = hot.where("xitem = 'HOT'").count()
    assert rows_of_hot > hot.count() * 0.4
    per_range = 200
    placed = fifo._placed(hot.where("xitem = 'HOT'"), per_range)
    pieces = placed.selectExpr("explode(sequence(cast(floor(since / width) AS bigint), cast(ceil(upto / width) - 1 AS bigint))) AS r").groupBy("r").count()
    sizes = [r["count"] for r in pieces.collect()]
    assert len(sizes) >= rows_of_hot / per_range and max(sizes) < 4 * per_range
    days = placed.groupBy("side", "xdate").count().agg(F.max("count")).first()[0]
    assert days < rows_of_hot / 50
    assert found(fifo.fifo_matches(hot.where("xitem = 'HOT'"), per_range)) == found(fifo.fifo_matches(hot.where("xitem = 'HOT'")))


def test_no_pairs_are_formed(sample):
    plan = fifo.fifo_matches(sample.imtrn)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("xdate" in line for line in joins)  # lines meet the totals of their day


def test_what_became_of_a_receipt(spark, table):
    moves = [move(on="2024-01-01", doc="GRN-1", qty=10), move(on="2024-01-05", doc="GRN-2", qty=10), move(on="2024-01-03", doc="CO--1", qty=4),
             move(on="2024-01-06", doc="TO--1", qty=3), move(on="2024-01-08", doc="CO--2", qty=5), move(item="B", doc="CO--3", qty=2)]
    got = rows(fifo.receipt_sales(table("imtrn", *moves)), "xgrnnum", "received", "sold", "gone", "left", "unit_days")
    assert got == [("GRN-1", n("10.00"), n("7.00"), n("3.00"), n("0.00"), n("29.00")),
                   ("GRN-2", n("10.00"), n("2.00"), n("0.00"), n("8.00"), n("6.00"))]
    layers = rows(fifo.stock_layers(table("imtrn", *moves)), "xitem", "missing", "units")
    assert layers == [("A-1", False, n("8.00")), ("B", True, n("-2.00"))]
    assert fifo.receipt_sales(table("imtrn")).count() == 0


def test_an_end_just_below_a_range_is_not_rounded_into_it(table):
    """0.01 units short of a range of five million: a quotient of six digits would be rounded up to the range's start."""
    moves = table("imtrn", move(doc="GRN-1", qty="4999999.99", line=1), move(doc="GRN-2", qty="5000000.01", line=2),
                  move(doc="CO--1", qty="4999999.99", on="2024-01-02", line=1), move(doc="CO--2", qty="5000000.01", on="2024-01-02", line=2))
    pairs = fifo.fifo_matches(moves, per_range=2).groupBy("came.xdocnum", "went.xdocnum").agg(F.sum("units").alias("units"))
    assert sorted((r[0], r[1], float(r[2])) for r in pairs.collect()) == [("GRN-1", "CO--1", 4999999.99), ("GRN-2", "CO--2", 5000000.01)]


def test_ends_of_both_sides_are_not_grouped(sample):
    """The window over a range's ends sorts once; grouping the ends first sorted and dealt out all of them before it."""
    plan = fifo.fifo_matches(sample.imtrn)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
