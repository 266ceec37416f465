from collections import Counter
from datetime import date

from conftest import d, move, n, rows
from test_stock import model

from ledgerloom.operators import counting


def pool_frame(spark, *entries):
    return spark.createDataFrame(
        [(z, i, w, n(1), n(v)) for z, i, w, v in entries],
        "zid int, xitem string, xwh string, stockqty decimal(18,2), stockvalue decimal(18,2)")


def test_pool_keeps_rooms_apart_and_skips_counted(spark, table):
    m = model(spark, table, [move("A-1", val=9, wh="X"), move("A-1", val=5, wh="Y"), move("B-1", val=100),
                             move("C-1", val=1)])
    counted = spark.createDataFrame([(100002, "B-1")], "zid int, xitem string")
    got = rows(counting.count_pool(m, counted, 2), "xitem", "xwh", "stockvalue")
    assert got == [("A-1", "X", n(9)), ("A-1", "Y", n(5))]


def test_pool_ranks_inside_each_task_first(spark, sample):
    plan = counting.count_pool(sample, sample.count_history, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_nothing_of_value_is_drawn_evenly(spark):
    pool = pool_frame(spark, *[(1, f"I{i}", "W", -i) for i in range(6)])
    drawn = Counter()
    for seed in range(40):
        picks = rows(counting.count_picks(pool, 2, seed), "xitem")
        assert len(set(picks)) == 2
        drawn.update(picks)
    assert len(drawn) == 6


def test_worthless_rows_wait_until_value_is_gone(spark):
    pool = pool_frame(spark, (1, "a", "W", 10), (1, "b", "W", 0), (1, "c", "W", -5), (1, "d", "W", 1))
    for seed in range(15):
        assert rows(counting.count_picks(pool, 2, seed), "xitem") == [("a",), ("d",)]
        assert len(rows(counting.count_picks(pool, 3, seed))) == 3


def test_value_raises_the_chance(spark):
    pool = pool_frame(spark, (1, "heavy", "W", 90), (1, "light", "W", 10))
    heavy = sum(rows(counting.count_picks(pool, 1, s), "xitem") == [("heavy",)] for s in range(80))
    assert 60 <= heavy <= 79


def test_picks_come_from_pool_and_enter_history(sample):
    pool = counting.count_pool(sample, sample.count_history, 20)
    picks = counting.count_picks(pool, 3, 1)
    assert set(rows(picks, "zid", "xitem")) <= set(rows(pool, "zid", "xitem"))
    assert not set(rows(picks, "zid", "xitem")) & set(rows(sample.count_history, "zid", "xitem"))
    after = counting.count_history(sample.count_history, picks, d("2001-06-30"))
    assert set(rows(picks, "zid", "xitem")) <= set(rows(after, "zid", "xitem"))
    assert rows(counting.count_history(sample.count_history, picks, d("2001-07-01")), "quarter_start")[0] == (
        date(2001, 7, 1),)


def test_units_without_pool_are_not_chosen(spark):
    pool = pool_frame(spark, (1, "a", "W", 1), (3, "b", "W", 1))
    seen = {rows(counting.choose_units(pool, 1, s))[0][0] for s in range(20)}
    assert seen == {1, 3}
    assert len(rows(counting.choose_units(pool, 5, 0))) == 2


def test_days_off_and_holidays(spark):
    days = spark.createDataFrame([(d(f"2024-05-0{i}"),) for i in range(1, 8)], "xdate date")
    got = rows(counting.working_days(days, holidays=[d("2024-05-01")]), "xdate")
    assert [r[0].day for r in got] == [2, 4, 5, 6, 7]
    assert len(rows(counting.working_days(days, days_off=()))) == 7


def test_equal_pools_of_units_draw_differently(spark):
    pool = pool_frame(spark, *[(z, f"I{i}", "W", 10) for z in (1, 2, 3) for i in range(60)])
    drawn = {}
    for unit, item in rows(counting.count_picks(pool, 5, 7), "zid", "xitem"):
        drawn.setdefault(unit, set()).add(item)
    assert len({frozenset(x) for x in drawn.values()}) == 3


def test_only_chosen_units_are_picked(spark):
    pool = pool_frame(spark, *[(z, f"I{i}", "W", 10) for z in (1, 2, 3) for i in range(9)])
    units = counting.choose_units(pool, 1, 3)
    assert {r[0] for r in rows(counting.count_picks(pool, 2, 7, units), "zid")} == {r[0] for r in rows(units, "zid")}
