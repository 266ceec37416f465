import json
import os

import pytest
from conftest import d, move, n, rows

from ledgerloom.model import Model
from ledgerloom.operators import stock
from ledgerloom.schemas import SHEET_HEADERS
from ledgerloom.sources import readers, shared, sinks
from ledgerloom.streaming import jobs


def test_tables_round_trip(spark, table, tmp_path):
    table("imtrn", move(qty=3)).write.parquet(str(tmp_path / "imtrn"))
    m = Model.from_tables(spark, str(tmp_path))
    assert rows(m.imtrn, "xitem", "xqty") == [("A-1", n(3))]
    filtered = m.imtrn.filter("zid = 100002 and xdate >= date'2024-01-01' and startswith(xdocnum, 'GRN-')")
    plan = filtered.select("xitem")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(xdate" in plan and "StringStartsWith(xdocnum,GRN-)" in plan
    assert "xwh" not in plan.split("ReadSchema")[1]


def test_star_types_are_read_by_stored_columns(spark, sample):
    plan = sample.pogdt._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_linestatus,F)" in plan and "l_discount" not in plan.split("ReadSchema")[1]


def test_unknown_table(spark):
    with pytest.raises(AttributeError):
        Model(spark, {}).nothing


def test_catalog_sheet_headers(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    cells = {"Business ID": "100002", "Item Code": "04-1", "Standard Price": "12.5", "Brand": "B"}
    path.write_text(",".join(SHEET_HEADERS) + "\n" + ",".join(cells.get(h, "") for h in SHEET_HEADERS) + "\n")
    df = readers.read_catalog_sheet(spark, str(path))
    assert len(df.columns) == 37
    assert rows(df, "zid", "xitem", "xstdprice", "xbrand", "xcolor") == [(100002, "04-1", n("12.50"), "B", None)]


def test_web_documents(spark, tmp_path):
    page = {"id": 5, "status": "done", "total": "3", "line_items": [{"id": 1, "sku": "A", "price": 2}], "junk": 1}
    (tmp_path / "page1.json").write_text(json.dumps(page) + "\n")
    (tmp_path / "page2.json").write_text(json.dumps({"id": 6, "sku": "A", "regular_price": ""}) + "\n")
    got = readers.read_web_orders(spark, str(tmp_path / "page1.json")).first()
    assert got.line_items[0].sku == "A" and got.date_completed is None
    assert readers.read_web_products(spark, str(tmp_path / "page2.json")).first().regular_price == ""


def test_report_parts_per_unit(spark, sample, tmp_path):
    balance = stock.inventory_balance(sample)
    for fmt in ("parquet", "csv"):
        sinks.write_report(balance, str(tmp_path / fmt), fmt=fmt)
        assert {p.name for p in (tmp_path / fmt).glob("zid=*")} == {"zid=100001", "zid=100002", "zid=100003"}
    back = spark.read.parquet(str(tmp_path / "parquet")).select(*balance.columns)
    assert rows(back) == rows(balance)


def test_report_of_one_unit_keeps_the_others(spark, sample, tmp_path):
    balance = stock.inventory_balance(sample)
    sinks.write_report(balance, str(tmp_path / "all"))
    sinks.write_report(balance.filter("zid = 100001").limit(2), str(tmp_path / "all"))
    back = {r.zid: r["count"] for r in spark.read.parquet(str(tmp_path / "all")).groupBy("zid").count().collect()}
    assert back[100001] == 2 and set(back) == {100001, 100002, 100003}


def test_database_without_partition_options_is_refused(spark):
    with pytest.raises(ValueError, match="partitionColumn"):
        readers.read_table(spark, {"url": "jdbc:none"}, "imtrn")


def test_snapshot_replaces_its_own_day_only(spark, sample, tmp_path):
    path, now = str(tmp_path / "snap"), stock.multi_branch_stock(sample)
    sinks.write_snapshot(now, path, "2001-06-29")
    sinks.write_snapshot(now.limit(3), path, "2001-06-30")
    sinks.write_snapshot(now.limit(5), path, "2001-06-30")
    assert readers.read_snapshot(spark, path, "2001-06-30").count() == 5
    yesterday = readers.read_snapshot(spark, path, "2001-06-29")
    assert rows(stock.stock_changes(now, yesterday)) == []


def test_shared_folder_is_taken_from_the_session(spark):
    assert shared.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def landed(spark, folder, entries):
    """One file per page of order changes, in landing order."""
    folder.mkdir(exist_ok=True)
    for i, page in enumerate(entries):
        file = folder / f"p{len(list(folder.iterdir()))}.json"
        file.write_text("".join(json.dumps(e) + "\n" for e in page))
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def change(key, status, modified):
    return {"id": key, "status": status, "date_modified": modified, "date_created": "2024-01-01", "total": "1"}


@pytest.mark.parametrize("files", [None, 1])
def test_order_stream_equals_batch_in_any_number_of_batches(spark, tmp_path, files):
    pages = landed(spark, tmp_path / "pages", [
        [change(k, "processing", f"2024-01-{1 + k:02d}") for k in range(9)],
        [change(k, "done", f"2024-01-{5 + k % 3:02d}") for k in range(9)],
        [change(3, "late", "2023-01-01")]])
    newest = {k: ("done" if 5 + k % 3 >= 1 + k else "processing") for k in range(9)}
    state = jobs.OrderState(spark, str(tmp_path / "state"))
    for _ in range(2):  # a restart finds nothing new
        jobs.stream_order_status(jobs.page_stream(spark, pages, files), state, str(tmp_path / "cp")).awaitTermination()
    last = jobs.last_batch(spark, str(tmp_path / "cp"))
    assert last == (2 if files else 0)
    assert dict(rows(state.state(last), "id", "status")) == newest


def test_equally_new_changes_are_settled_by_landing(spark, tmp_path):
    same = "2024-01-01T00:00:00"
    pages = landed(spark, tmp_path / "pages", [[change(1, "processing", same)],
                                               [change(1, "completed", same), change(2, "b", same), change(2, "a", same)]])
    for files in (None, 1):
        state = jobs.OrderState(spark, str(tmp_path / f"state{files}"))
        checkpoint = str(tmp_path / f"cp{files}")
        jobs.stream_order_status(jobs.page_stream(spark, pages, files), state, checkpoint).awaitTermination()
        assert rows(state.state(jobs.last_batch(spark, checkpoint)), "id", "status") == [(1, "completed"), (2, "a")]


@pytest.fixture(scope="module")
def move_files(spark, sample, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("moves") / "m")
    sample.imtrn.drop("xdisc").repartition(5).write.parquet(folder)
    return folder


def test_balance_stream_equals_batch(spark, sample, move_files, tmp_path):
    log, checkpoint = jobs.balance_log(spark, str(tmp_path / "log"), every=2), str(tmp_path / "cp")
    jobs.stream_stock_balance(jobs.movement_stream(spark, move_files, 1), log, checkpoint).awaitTermination()
    batch = stock.inventory_balance(sample).select("zid", "xitem", "inventory")
    assert jobs.last_batch(spark, checkpoint) == 4
    assert rows(log.state(4), "zid", "xitem", "inventory") == rows(batch)


def test_log_reads_the_last_whole_state_and_what_came_since(spark, table, tmp_path):
    log = jobs.balance_log(spark, str(tmp_path / "log"), every=3)
    log.open()
    for batch in range(8):
        balance = spark.createDataFrame([(1, f"I{batch % 3}", batch, None)], jobs.BALANCE_STATE.replace("decimal(38,2)", "int"))
        log.write(balance.selectExpr("zid", "xitem", "cast(inventory as decimal(38,2)) inventory", "cast(previous as decimal(38,2)) previous"), batch)
    assert rows(log.state(7), "xitem", "inventory") == [("I0", n("6.00")), ("I1", n("7.00")), ("I2", n("5.00"))]
    plan = log.state(7)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Relation [") == 1
    assert {f.split("/")[-2] for f in log.state(7).inputFiles()} == {"batch=5", "batch=6", "batch=7"}


def test_change_stream_in_several_batches(spark, sample, move_files, tmp_path):
    day = "2001-06-30"
    before = stock.inventory_balance(sample, as_of=d(day)).select("zid", "xitem", "inventory")
    state, checkpoint = jobs.BalanceState(spark, str(tmp_path / "state")), str(tmp_path / "cp")
    late = jobs.movement_stream(spark, move_files, 1).filter(f"xdate > date '{day}'")
    jobs.stream_stock_changes(late, state, checkpoint, jobs.running_balances(sample.imtrn.filter(f"xdate <= date '{day}'"))).awaitTermination()
    got = jobs.changed_since(state, jobs.last_batch(spark, checkpoint))
    want = stock.stock_changes(stock.inventory_balance(sample), before, ["zid", "xitem"], "inventory")
    assert rows(got, "zid", "xitem", "inventory") == rows(want, "zid", "xitem", "inventory")
