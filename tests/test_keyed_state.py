"""State by key: a batch opens its own buckets, a replay changes nothing, closed orders leave and are still found."""

import random
from collections import defaultdict

import pytest
from conftest import move, n, rows

from ledgerloom.sources import shared
from ledgerloom.streaming import jobs
from ledgerloom.streaming.keyed import ARCHIVE, LIVE


@pytest.fixture
def opened(monkeypatch):
    """(area, bucket) of every file that is opened."""
    seen = []
    read = jobs.KeyedState._read

    def watched(self, parts):
        seen.extend((area, k) for _, area, k in parts)
        return read(self, parts)

    monkeypatch.setattr(jobs.KeyedState, "_read", watched)
    return seen


def start_of(spark, items):
    return spark.createDataFrame([(1, f"I-{i}", 10 * i) for i in range(items)], "zid int, xitem string, q int").selectExpr(
        "zid", "xitem", "cast(q AS decimal(38,2)) AS inventory")


def test_a_batch_opens_the_buckets_of_its_items_only(spark, table, tmp_path, opened):
    state = jobs.BalanceState(spark, str(tmp_path / "s"), buckets=64)
    state.start(start_of(spark, 600))
    state.apply(table("imtrn", *[move(item=f"I-{i}", qty=5, zid=1, sign=1) for i in range(10)]), 0)
    touched = {r.b for r in spark.createDataFrame([(1, f"I-{i}") for i in range(10)], "zid int, xitem string").select(
        state.bucket().alias("b")).collect()}
    assert {k for _, k in opened} <= touched and len(touched) <= 10
    assert len(state.manifest(0)["areas"][LIVE]) == 64
    written = {int(p.name.split("=")[1]) for p in (tmp_path / "s/rows/batch=0/area=live").glob("bucket=*")}
    assert written == touched
    opened.clear()
    got = rows(state.batch(0), "xitem", "inventory", "previous")
    assert {k for _, k in opened} == touched
    assert got == sorted((f"I-{i}", n(f"{10 * i + 5}.00"), n(f"{10 * i}.00")) for i in range(10))
    opened.clear()
    assert jobs.changed_since(state, 0).count() == 10 and {k for _, k in opened} == touched


def test_many_batches_with_replays_equal_one_sum(spark, table, tmp_path):
    rng = random.Random(4)
    state = jobs.BalanceState(spark, str(tmp_path / "s"), buckets=8)
    state.start(start_of(spark, 12))
    balance = {f"I-{i}": 10 * i for i in range(12)}
    for batch in range(6):
        moves = [move(item=f"I-{rng.randrange(20)}", qty=rng.randint(1, 9), zid=1, sign=rng.choice([1, -1]), line=k) for k in range(15)]
        was, change = dict(balance), defaultdict(int)
        for m in moves:
            change[m["xitem"]] += int(m["xqty"]) * m["xsign"]
        for i, q in change.items():
            balance[i] = balance.get(i, 0) + q
        for _ in range(1 + batch % 2):  # every second batch is run again
            state.apply(table("imtrn", *moves), batch)
        expected = sorted((i, n(f"{balance[i]}.00"), None if i not in was else n(f"{was[i]}.00")) for i in change)
        assert rows(state.batch(batch), "xitem", "inventory", "previous") == expected
    assert dict(rows(state.state(5), "xitem", "inventory")) == {i: n(f"{q}.00") for i, q in balance.items()}
    # a job that starts anew with another number of buckets keeps what is there
    again = jobs.BalanceState(spark, str(tmp_path / "s"), buckets=3)
    again.start(None)
    again.apply(table("imtrn", move(item="I-1", qty=1, zid=1, sign=1)), 6)
    assert again.buckets == 8 and dict(rows(again.state(6), "xitem", "inventory"))["I-1"] == n(f"{balance['I-1'] + 1}.00")


def test_old_files_can_go(spark, table, tmp_path):
    state = jobs.BalanceState(spark, str(tmp_path / "s"), buckets=2)
    state.start(start_of(spark, 4))
    for batch in range(4):
        state.apply(table("imtrn", *[move(item=f"I-{i}", qty=1, zid=1, sign=1) for i in range(4)]), batch)
    want = rows(state.state(3))
    assert state.expire(3) == 6  # two buckets of batches 0 to 2
    assert rows(state.state(3)) == want
    state.apply(table("imtrn", move(item="I-1", qty=1, zid=1, sign=1)), 4)
    assert dict(rows(state.state(4), "xitem", "inventory"))["I-1"] == n("15.00")


# --- orders that leave

def changes(spark, *entries, file="p"):
    return spark.createDataFrame([(i, day, status, "2024-01-01", "1", (None, file, k)) for k, (i, day, status) in enumerate(entries)],
                                 "id bigint, date_modified string, status string, date_created string, total string, "
                                 "landed struct<at: timestamp, file: string, row: bigint>")


def test_closed_orders_leave_and_late_changes_find_them(spark, tmp_path, opened):
    state = jobs.OrderState(spark, str(tmp_path / "s"), stay=10, sweep=5, buckets=8)
    state.open()
    state.apply(changes(spark, *[(i, "2024-01-02", "completed" if i % 3 else "processing") for i in range(60)]), 0)
    assert (state.read(0).count(), state.read(0, ARCHIVE).count()) == (60, 0)
    state.apply(changes(spark, (1000, "2024-02-10", "processing")), 1)
    assert (state.read(1).count(), state.read(1, ARCHIVE).count()) == (21, 40)  # 20 open ones and the new one
    assert state.state(1).count() == 61
    # late, but newer than what is filed: it comes back; older: the filed one is the answer
    opened.clear()
    state.apply(changes(spark, (1, "2024-02-09", "refunded"), (2, "2024-01-01", "processing"), file="q"), 2)
    buckets = {r.b for r in spark.createDataFrame([(1,), (2,)], "id bigint").select(state.bucket().alias("b")).collect()}
    assert {k for _, k in opened} <= buckets
    now = dict(rows(state.state(2), "id", "status"))
    assert now[1] == "refunded" and now[2] == "completed" and len(now) == 61
    assert 1 in {r.id for r in state.read(2).collect()}
    state.apply(changes(spark, (1, "2024-02-09", "refunded"), (2, "2024-01-01", "processing"), file="q"), 2)  # replay
    assert dict(rows(state.state(2), "id", "status")) == now


def test_an_untouched_bucket_is_opened_once_a_sweep(spark, tmp_path, opened):
    state = jobs.OrderState(spark, str(tmp_path / "s"), stay=1, sweep=10, buckets=4)
    state.open()
    state.apply(changes(spark, *[(i, f"2024-01-{1 + i % 9:02d}", "completed") for i in range(80)]), 0)
    days = 0
    for batch, day in enumerate(range(10, 31, 4), 1):
        opened.clear()
        state.apply(changes(spark, (5000, f"2024-01-{day:02d}", "processing")), batch)
        days += len({k for _, k in opened}) > 1
    assert days <= 2 and state.read(batch).count() == 1 and state.state(batch).count() == 81


def test_no_change_is_lost_in_random_streams(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "MOST_PARTS", 2)  # crowded buckets of the archive are put together
    rng = random.Random(9)
    state = jobs.OrderState(spark, str(tmp_path / "s"), stay=4, sweep=2, buckets=4)
    state.open()
    newest = {}
    for batch in range(7):
        entries = [(rng.randrange(40), f"2024-01-{max(1, min(31, 4 * batch + rng.randint(-9, 3))):02d}",
                    rng.choice(["processing", "completed", "order-cancelled"])) for _ in range(15)]
        state.apply(changes(spark, *entries, file=f"p{batch}"), batch)
        for k, (i, day, status) in enumerate(entries):
            newest[i] = max(newest.get(i, ("", -1, -1, "")), (day, batch, k, status))
        assert dict(rows(state.state(batch), "id", "status")) == {i: v[3] for i, v in newest.items()}
    parts = state.manifest(6)["areas"][ARCHIVE].values()
    assert any(p < 0 for ps in parts for p in ps) and max(map(len, parts)) <= 3
    assert state.read(6).count() < len(newest)


def test_the_state_lies_in_the_shared_folder(spark):
    assert shared.new_folder(spark, "order-status").startswith(spark.conf.get("spark.checkpoint.dir"))
