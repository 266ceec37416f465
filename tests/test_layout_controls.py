"""Tables in buckets, control totals and balanced reads from a database."""

import pytest
from conftest import d, item, move, n, rows
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from ledgerloom.operators import ledger, stock
from ledgerloom.plans.params import DEFAULT as P
from ledgerloom.schemas import TABLES
from ledgerloom.sources import controls, layout, readers


@pytest.fixture
def planned(spark):
    """Plans without adaptive execution and without broadcasts, as for tables of any size."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for k, v in before.items():
        spark.conf.set(k, v)


def test_joins_of_laid_out_tables_have_no_exchange(spark, sample, tmp_path, planned):
    folder = str(tmp_path / "laid")
    layout.write_layout(sample, folder, 4, ["glheader", "gldetail", "imtrn", "caitem"], "t1_")
    m = layout.open_layout(spark, folder, sample, "t2_")  # as another session would
    header_lines = m.glheader.join(m.gldetail, ["zid", "xvoucher"])
    assert "SortMergeJoin" in planned(header_lines) and "Exchange" not in planned(header_lines)
    balance = stock.inventory_balance(m)
    assert "SortMergeJoin" in planned(balance) and "Exchange" not in planned(balance)
    assert "Exchange" in planned(stock.inventory_balance(sample))
    assert rows(balance) == rows(stock.inventory_balance(sample))
    assert rows(ledger.gl_entries(m, end=P.ledger_end)) == rows(ledger.gl_entries(sample, end=P.ledger_end))


def test_tables_that_are_not_laid_out_come_from_the_base(spark, sample, tmp_path):
    layout.write_layout(sample, str(tmp_path / "laid"), 2, ["caitem"], "t3_")
    m = layout.open_layout(spark, str(tmp_path / "laid"), sample, "t3_")
    assert m.pogdt.count() == sample.pogdt.count()
    assert len(list((tmp_path / "laid" / "caitem").glob("part-*"))) <= 2
    alone = layout.open_layout(spark, str(tmp_path / "laid"), None, "t4_")
    with pytest.raises(AttributeError):
        alone.pogdt


# --- control totals

LEDGER = {"qty": "sum(xqty * xsign)", "value": "sum(xval * xsign)"}


def balance_of(moves):
    return moves.groupBy("zid", "xitem").agg(F.sum(F.expr("xqty * xsign")).alias("q"), F.sum(F.expr("xval * xsign")).alias("v"))


def test_a_report_that_adds_up_is_shown(spark, sample, tmp_path):
    source = controls.Controlled(sample.imtrn, LEDGER)
    totals = controls.publish(balance_of(source.rows), str(tmp_path / "r"), {"qty": "sum(q)", "value": "sum(v)"}, source)
    shown = controls.read_published(spark, str(tmp_path / "r"))
    assert totals["n_rows"] == shown.count() and rows(shown) == rows(balance_of(sample.imtrn))


def test_a_lost_row_is_refused_and_the_last_good_report_stays(spark, table, tmp_path):
    path = str(tmp_path / "r")
    moves = table("imtrn", move(qty=3), move(item="B", qty=2, doc="CO--1"), move(item="GONE", qty=7))
    names = table("caitem", item("A-1"), item("B"))
    whole = controls.Controlled(moves.where("xitem <> 'GONE'"), LEDGER)
    controls.publish(balance_of(whole.rows), path, {"qty": "sum(q)"}, whole)
    source = controls.Controlled(moves, LEDGER)
    lossy = balance_of(source.rows).join(names.select("zid", "xitem"), ["zid", "xitem"])  # an item without a master row
    with pytest.raises(controls.ControlError, match="qty: 8.00 in the ledger, 1.00 in the report"):
        controls.publish(lossy, path, {"qty": "sum(q)"}, source)
    assert rows(controls.read_published(spark, path), "xitem", "q") == [("A-1", n("3.00")), ("B", n("-2.00"))]
    doubled = controls.Controlled(moves, LEDGER)
    with pytest.raises(controls.ControlError):
        controls.publish(balance_of(doubled.rows).union(balance_of(moves)), path, {"value": "sum(v)"}, doubled)
    empty = controls.Controlled(moves.where("false"), LEDGER)
    assert controls.publish(balance_of(empty.rows), path, {"qty": "sum(q)"}, empty)["n_rows"] == 0
    assert controls.drop_hidden(spark, path) == 1 and controls.read_published(spark, path).count() == 0


def test_the_ledger_is_read_once(sample, planned):
    source = controls.Controlled(sample.imtrn, LEDGER)
    watched, _ = controls._observe(balance_of(source.rows), {"qty": "sum(q)"})
    plan = planned(watched)
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 2


# --- databases

KEYS = {
    "skewed": [1] * 500 + list(range(2, 60)) + [10**12],
    "sparse": [i * (1 << 33) - 5 for i in range(90)],
    "one": [7] * 50, "few": [3, 3, 9], "none": [], "missing": [None] * 20 + [1, 2, 3],
    "text": ["IT-1"] * 40 + [f"IT-{i:03d}" for i in range(60)] + ["O'Neil", None],
}


@pytest.mark.parametrize("name", sorted(KEYS))
@pytest.mark.parametrize("parts", [2, 8])
def test_predicates_part_the_rows(spark, name, parts):
    kind = "string" if name == "text" else "bigint"
    df = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS[name])], f"k {kind}, i int")
    cuts = sorted(set(k for k in KEYS[name] if k is not None))[:: max(1, len(KEYS[name]) // parts)] if name == "text" else (
        readers.measured_cuts(df, "k", parts))
    predicates = readers.balanced_predicates("k", cuts)
    hits = [df.where(p).select("i").collect() for p in predicates]
    assert sorted(r.i for part in hits for r in part) == list(range(len(KEYS[name])))
    if name == "sparse":
        assert max(map(len, hits)) <= 2 * len(KEYS[name]) / parts
    if name == "skewed":  # the hot key alone is a part, the others are parted evenly
        assert max(len(part) for part in hits) <= 500 + 60 and len(predicates) >= 2


@pytest.fixture
def asked(monkeypatch, spark):
    """What the database reader is asked for; no database is opened."""
    seen = {}
    monkeypatch.setattr(DataFrameReader, "format", lambda self, name: seen.update(format=name) or self)
    monkeypatch.setattr(DataFrameReader, "options", lambda self, **o: seen.update(options=o) or self)
    empty = lambda name: spark.createDataFrame([], TABLES[name])
    monkeypatch.setattr(DataFrameReader, "load", lambda self: empty(seen["options"]["dbtable"]))
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **o: seen.update(url=url, table=table, **o) or empty(table))
    return seen


SOURCE = {"url": "jdbc:postgresql://erp/db", "user": "reader", "driver": "org.postgresql.Driver", "fetchsize": 10_000,
          "partitionColumn": "zid", "lowerBound": 100001, "upperBound": 100003, "numPartitions": 3}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_options_handed_to_the_reader(spark, asked, name):
    df = readers.read_table(spark, SOURCE, name)
    assert asked == {"format": "jdbc", "options": {**SOURCE, "dbtable": name}}
    assert df.columns == spark.createDataFrame([], TABLES[name]).columns


def test_measured_cuts_become_predicates_of_the_reader(spark, asked):
    source = {**SOURCE, "cuts": {"imtrn": ("xdate", [d("2020-01-01"), d("2022-01-01")])}}
    readers.read_table(spark, source, "imtrn")
    assert asked["predicates"] == ["xdate < '2020-01-01' OR xdate IS NULL", "xdate >= '2020-01-01' AND xdate < '2022-01-01'", "xdate >= '2022-01-01'"]
    assert asked["properties"] == {"user": "reader", "driver": "org.postgresql.Driver", "fetchsize": "10000"}
    assert (asked["url"], asked["table"]) == (SOURCE["url"], "imtrn")
    asked.clear()
    readers.read_table(spark, source, "caitem")
    assert "cuts" not in asked["options"]


def test_buckets_grow_with_the_rows(sample):
    tables = ["imtrn", "caitem"]
    moves = sample.imtrn.count()
    assert layout.buckets_for(sample, tables, 8) == 8
    assert layout.buckets_for(sample, tables, 8, 50) == -(-moves // 50)


def test_a_laid_out_report_has_more_buckets_over_more_rows(spark, monkeypatch):
    from conftest import SAMPLE

    from ledgerloom.plans.registry import QUERIES
    made, write = [], layout.write_layout
    monkeypatch.setattr(layout.buckets_for, "__defaults__", (1, 250))
    monkeypatch.setattr(layout, "write_layout", lambda m, folder, buckets, *a: (made.append(buckets), write(m, folder, buckets, *a))[1])
    assert QUERIES["inventory_balance_laid_out"](spark, SAMPLE).count() > 0
    assert made[0] > 8
