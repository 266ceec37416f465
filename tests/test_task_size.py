"""A task's part of a report must not grow with the tables."""

import re

import pytest
from conftest import SAMPLE
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.functions import numbering
from ledgerloom.plans.registry import QUERIES

GROWN = ["inventory_balance", "count_pool", "multi_branch_stock"]


def test_partitions_of_a_shuffle_grow_with_the_tables(spark):
    small, large = (int(session.sized_session(spark, b).conf.get(session.INITIAL)) for b in (1 << 20, 6 << 30))
    assert small == int(spark.conf.get(session.PARTITIONS))
    assert large * session.SHUFFLE_BYTES >= 6 << 30


def test_a_sized_session_keeps_what_the_caller_has_set(spark):
    caller = spark.newSession()
    caller.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    caller.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    caller.conf.set("spark.sql.shuffle.partitions", "7")
    caller.conf.set("spark.sql.session.timeZone", "Asia/Dhaka")
    before = caller.conf.getAll
    own = session.sized_session(caller, 0)
    assert session.size_of(own.conf.get("spark.sql.files.maxPartitionBytes")) == 2 << 20
    assert own.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert own.conf.get(session.INITIAL) == "7"
    assert own.conf.get("spark.sql.session.timeZone") == "Asia/Dhaka"
    assert caller.conf.getAll == before


def test_sizes_are_read_in_any_unit():
    assert [session.size_of(s) for s in ("10", "64MB", "128m", "1048576b", "2GB", "-1", "256k")] == [
        10, 64 << 20, 128 << 20, 1 << 20, 2 << 30, -1, 256 << 10]


@pytest.mark.parametrize("name", GROWN)
def test_every_report_runs_in_a_sized_session(spark, name):
    own = QUERIES[name](spark, SAMPLE).sparkSession
    for key, most in session.TASKS.items():
        assert session.size_of(own.conf.get(key)) <= most


@pytest.mark.parametrize("name", GROWN)
def test_items_of_few_bytes_and_many_rows_are_not_broadcast(spark, tmp_path, name):
    """A broadcast side is held whole by every task; file bytes tell little of it."""
    larger = SAMPLE.replace("sf0.001", "sf0.1")
    for table in ("lineitem", "orders"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{larger}/{table}.parquet")
    copies = spark.range(12).withColumnRenamed("id", "copy")
    many = spark.read.parquet(f"{larger}/part.parquet").crossJoin(copies).withColumn("p_partkey", F.expr("p_partkey + copy * 20000"))
    many.drop("copy").write.parquet(str(tmp_path / "part.parquet"))
    report = QUERIES[name](spark, str(tmp_path))
    assert "Broadcast" not in report._jdf.queryExecution().sparkPlan().toString()


#: Reports that share the steps of those above.
SHARED = ["choose_units", "count_history", "stock_quantity_sync", "stock_quantity_sync_nonzero",
          "update_batches", "shipment_errors", "shipment_tracking"]


@pytest.fixture(scope="module")
def many_items(spark, tmp_path_factory):
    """Tables of sf0.1 with twelve times the items: few bytes of parquet, many rows."""
    folder = tmp_path_factory.mktemp("many")
    larger = SAMPLE.replace("sf0.001", "sf0.1")
    for table in ("lineitem", "orders"):
        (folder / f"{table}.parquet").symlink_to(f"{larger}/{table}.parquet")
    copies = spark.range(12).withColumnRenamed("id", "copy")
    many = spark.read.parquet(f"{larger}/part.parquet").crossJoin(copies).withColumn("p_partkey", F.expr("p_partkey + copy * 20000"))
    many.drop("copy").write.parquet(str(folder / "part.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", SHARED)
def test_no_task_of_a_sharing_report_holds_all_items(spark, many_items, monkeypatch, name):
    """Joins by item are not planned as broadcasts, also where a report writes its rows out on the way."""
    plans, written = [], numbering.written_once
    monkeypatch.setattr(numbering, "written_once", lambda df: plans.append(df) or written(df))
    plans.append(QUERIES[name](spark, many_items))
    shown = "\n".join(df._jdf.queryExecution().sparkPlan().toString() for df in plans)
    assert re.search(r"SortMergeJoin \[[^\]]*(xitem|sku)#", shown)
    assert not re.search(r"Broadcast\w*Join \[[^\]]*(xitem|sku)#", shown)


@pytest.mark.parametrize("name", SHARED)
def test_shuffles_of_a_sharing_report_grow_with_the_tables(spark, many_items, name):
    """Each 4 MB of table files start a partition, where the caller asks for fewer."""
    caller = spark.newSession()
    caller.conf.set("spark.sql.shuffle.partitions", "1")
    own = QUERIES[name](caller, many_items).sparkSession
    initial = own.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    assert int(initial or own.conf.get("spark.sql.shuffle.partitions")) >= 4
