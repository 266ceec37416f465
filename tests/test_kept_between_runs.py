"""As-of totals from periods and history as intervals against computing everything anew."""

import random
from datetime import date, timedelta

import pytest
from conftest import d, move, n, rows
from pyspark.sql import functions as F

from ledgerloom.operators import ledger, stock
from ledgerloom.plans.params import DEFAULT as P
from ledgerloom.sources.history import History, stock_intervals
from ledgerloom.sources.periods import PeriodLedger
from ledgerloom.streaming.keyed import ARCHIVE

MEASURES = {"qty": "xqty * xsign", "value": "xval * xsign"}


@pytest.fixture(scope="module")
def kept(spark, sample, tmp_path_factory):
    """The sample's movements in three batches; the second and third are dated back into any month."""
    moves = sample.imtrn.drop("xdisc")
    store = PeriodLedger(spark, str(tmp_path_factory.mktemp("periods") / "p"), stock.KEY, MEASURES)
    part = F.crc32("xdocnum") % 10
    store.add(moves.where(part > 1), 0)
    store.add(moves.where(part == 1), 1)
    store.add(moves.where(part == 0), 2)
    store.add(moves.where(part == 1), 1)  # run again
    return store


def test_any_day_equals_the_full_scan(sample, kept):
    rng = random.Random(1)
    days = [P.as_of, date(1996, 1, 1), date(1996, 12, 31), date(1990, 1, 1), *(date(1994, 1, 1) + timedelta(rng.randrange(2900)) for _ in range(3))]
    for on in days:
        want = sample.imtrn.where(F.col("xdate") <= F.lit(str(on)).cast("date")).groupBy(*stock.KEY).agg(
            F.sum("xqty").alias("n"), F.sum(F.expr(MEASURES["qty"])).cast("decimal(38,2)").alias("qty"),
            F.sum(F.expr(MEASURES["value"])).cast("decimal(38,2)").alias("value"))
        assert rows(kept.as_of(on), *stock.KEY, "qty", "value") == rows(want, *stock.KEY, "qty", "value"), on


def test_only_the_months_tail_of_the_ledger_is_read(kept):
    on = d("1997-05-17")
    plan = kept.as_of(on)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("FileScan")[1:] if "/rows" in line.split("ReadSchema")[0]]
    assert len(scans) == 3  # one a batch
    assert all("(period" in s.split("PartitionFilters: [")[1].split("]")[0] and "= 199705)" in s for s in scans)
    read = kept.rows().where("period = 199705").select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("period=199705" in r.f for r in read)


def test_sums_put_together_give_the_same(spark, sample, tmp_path):
    store = PeriodLedger(spark, str(tmp_path / "p"), stock.KEY, MEASURES)
    store.add(sample.imtrn.where("zid = 100001"), 0)
    store.add(sample.imtrn.where("zid <> 100001"), 1)
    before = rows(store.as_of(P.as_of), *stock.KEY, "qty")
    store.merge()
    assert store._manifest()["sums"] == ["merged=1/sums"] and rows(store.as_of(P.as_of), *stock.KEY, "qty") == before
    assert store.sums().groupBy(*stock.KEY, "at").count().where("count > 1").count() == 0
    store.add(sample.imtrn.where("zid = 100001"), 2)  # a batch after the merge counts once more
    twice = {r[:2]: r[2] * (2 if r[0] == 100001 else 1) for r in before}
    assert {tuple(r[:2]): r[2] for r in rows(store.as_of(P.as_of), *stock.KEY, "qty")} == twice


def test_rows_without_their_sums_are_not_seen(spark, sample, tmp_path, monkeypatch):
    store = PeriodLedger(spark, str(tmp_path / "p"), stock.KEY, MEASURES)
    store.add(sample.imtrn.where("zid = 100001"), 0)
    before = rows(store.as_of(P.as_of), *stock.KEY, "qty")
    with monkeypatch.context() as patch:
        patch.setattr(PeriodLedger, "_write_sums", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.add(sample.imtrn.where("zid = 100002"), 1)
    assert rows(store.as_of(P.as_of), *stock.KEY, "qty") == before


def test_ledger_reports_from_periods(spark, sample, kept):
    assert rows(ledger.monthly_inventory_value_of(sample, kept, P.ledger_end)) == rows(ledger.monthly_inventory_value(sample, P.ledger_end))


# --- intervals

BALANCE = ("zid int, xitem string", "inventory decimal(38,2)")


def snapshot(spark, balances):
    return spark.createDataFrame([(1, k, n(f"{v}.00")) for k, v in balances.items()], "zid int, xitem string, inventory decimal(38,2)")


def test_any_past_day_is_its_snapshot(spark, tmp_path):
    rng = random.Random(6)
    store = History(spark, str(tmp_path / "h"), *BALANCE, buckets=4)
    balances, past = {f"I{i}": i for i in range(8)}, {}
    changes = 0
    for step in range(6):
        on = d("2024-01-30") + timedelta(step * 2)
        was = dict(balances)
        for i in rng.sample(range(10), 3):
            if rng.random() < 0.3:
                balances.pop(f"I{i}", None)
            else:
                balances[f"I{i}"] = rng.randrange(5)
        changes += sum(was.get(k) != balances.get(k) for k in {*was, *balances}) if step else len(balances)
        store.close_day(on, snapshot(spark, balances))
        past[on] = dict(balances)
    store.close_day(on, snapshot(spark, balances))  # the last day once more
    for on, want in past.items():
        for day_after in (0, 1):  # the day between two closings has the earlier values
            got = {r.xitem: int(r.inventory) for r in store.as_of(on + timedelta(day_after)).collect()}
            assert got == want, on
    assert store.as_of(d("2024-01-01")).count() == 0
    last = store._last()
    stored = store.read(last).count() + store.read(last, ARCHIVE).count()
    assert stored <= changes < 6 * 8  # grows with changes, not with days
    with pytest.raises(ValueError, match="before"):
        store.close_day(d("2024-01-01"), snapshot(spark, balances))


def test_changed_keys_open_their_own_buckets(spark, tmp_path):
    store = History(spark, str(tmp_path / "h"), *BALANCE, buckets=32)
    store.close_day(d("2024-01-01"), snapshot(spark, {f"I{i}": i for i in range(200)}))
    store.apply_changes(d("2024-01-02"), snapshot(spark, {"I7": 100, "NEW": 1}))
    assert len({p.name for p in (tmp_path / "h/rows/batch=1/area=live").glob("bucket=*")}) <= 2
    today = {r.xitem: int(r.inventory) for r in store.as_of(d("2024-01-02")).collect()}
    assert today["I7"] == 100 and today["NEW"] == 1 and len(today) == 201
    assert {r.xitem: int(r.inventory) for r in store.as_of(d("2024-01-01")).collect()} == {f"I{i}": i for i in range(200)}


def test_a_loaded_history_goes_on(spark, table, tmp_path):
    moves = table("imtrn", move(on="2024-01-01", qty=5), move(on="2024-01-03", doc="CO--1", qty=2), move(item="B", on="2024-01-02", qty=1),
                  move(item="B", on="2024-01-03", qty=4), move(item="B", on="2024-01-03", doc="CO--2", qty=4))
    intervals = stock_intervals(moves)
    assert rows(intervals, "xitem", "inventory", "valid_from", "valid_to") == [
        ("A-1", n("3.00"), d("2024-01-03"), None), ("A-1", n("5.00"), d("2024-01-01"), d("2024-01-03")),
        ("B", n("1.00"), d("2024-01-02"), None)]  # a day that cancels out opens none
    store = History(spark, str(tmp_path / "h"), *BALANCE, buckets=2)
    store.load(intervals, d("2024-01-03"))
    store.apply_changes(d("2024-01-05"), spark.createDataFrame([(100002, "A-1", n("9.00"))], "zid int, xitem string, inventory decimal(38,2)"))
    held = {on: sorted((r.xitem, int(r.inventory)) for r in store.as_of(d(on)).collect()) for on in (
        "2023-12-31", "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05")}
    assert list(held.values()) == [[], [("A-1", 5)], [("A-1", 5), ("B", 1)], [("A-1", 3), ("B", 1)], [("A-1", 3), ("B", 1)], [("A-1", 9), ("B", 1)]]


def test_sums_of_years_come_from_those_of_periods(spark, sample, tmp_path, monkeypatch):
    """Both levels in one grouping held every key twice in a task; now years read what periods wrote."""
    read, seen = type(spark.read).parquet, []
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: (seen.extend(paths), read(self, *paths))[1])
    store = PeriodLedger(spark, str(tmp_path / "p"), stock.KEY, {"qty": "xqty * xsign"})
    store.add(sample.imtrn, 0)
    assert f"{tmp_path}/p/batch=0/sums/level=period" in seen
    years = store.sums("year").groupBy().agg(F.sum("qty")).first()[0]
    assert years == store.sums("period").groupBy().agg(F.sum("qty")).first()[0] == sample.imtrn.agg(F.sum(F.expr("xqty * xsign"))).first()[0]
