"""Landed pages: a partition a page, pages left out by date, batch and stream alike."""

import json

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, LessThan
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.operators import orders
from ledgerloom.plans.params import DEFAULT as P
from ledgerloom.sources import pages


def some_orders(spark, first, last, month=1):
    return spark.range(first, last).selectExpr(
        "id", "'processing' AS status", f"format_string('2024-%02d-%02dT10:00:00', {month}, cast(id % 28 + 1 AS int)) AS date_created",
        "format_string('2024-06-%02d', cast(id % 28 + 1 AS int)) AS date_modified", "cast(id AS string) AS total",
        "array(named_struct('id', id, 'name', 'n', 'sku', 'S')) AS line_items")


@pytest.fixture
def folder(spark, tmp_path):
    """Two landings: January in pages of 10, February in pages of 7."""
    where = str(tmp_path / "landed")
    pages.land_pages(some_orders(spark, 0, 100), where, 0, per_page=10)
    pages.land_pages(some_orders(spark, 100, 150, month=2), where, 1, per_page=7)
    return where


def read_by_page(folder, *tests):
    reader = pages.PageReader({"path": folder}, some_schema())
    assert list(reader.pushFilters(list(tests))) == list(tests)  # all are tested again
    return reader.partitions()


def some_schema():
    from pyspark.sql.types import StructType
    return StructType.fromDDL(pages.WEB_ORDER)


def test_every_page_is_a_partition_and_every_document_comes(spark, folder):
    docs = pages.read_pages(spark, folder)
    everything = read_by_page(folder)
    assert docs.rdd.getNumPartitions() == len(everything) >= 10 + 8
    assert sorted(r.id for r in docs.collect()) == list(range(150))
    assert docs.where("id = 7").first().line_items[0].sku == "S"
    assert max(len(ids) for ids in docs.select("id", F.spark_partition_id().alias("p")).groupBy("p").agg(
        F.collect_list("id").alias("ids")).toPandas().ids) <= 10


def test_a_cut_off_leaves_pages_unopened(spark, folder):
    everything = len(read_by_page(folder))
    january_end = read_by_page(folder, GreaterThanOrEqual(("date_created",), "2024-01-20"))
    february = read_by_page(folder, GreaterThan(("date_created",), "2024-02-01"))
    assert len(february) < len(january_end) < everything
    assert all("landing=1" in p.path for p in february)
    assert len(read_by_page(folder, LessThan(("date_created",), "2024-01-02"))) < everything
    assert read_by_page(folder, EqualTo(("date_created",), "2025-01-01")) == []
    assert len(read_by_page(folder, GreaterThan(("total",), "2024"), GreaterThan(("id",), 3))) == everything
    # Spark pushes it: the scan has as many tasks as pages are left
    docs = pages.read_pages(spark, folder, after="2024-02-01")
    assert docs.rdd.getNumPartitions() == len(february)
    assert sorted(r.id for r in docs.collect()) == list(range(100, 150))
    cut = pages.read_pages(spark, folder, after="2024-01-20T10:00:00")
    want = [i for i in range(100) if i % 28 + 1 >= 20] + list(range(100, 150))
    assert sorted(r.id for r in cut.collect()) == want


def test_a_landing_shows_once_its_index_is_complete(spark, folder, tmp_path):
    some_orders(spark, 500, 510).write.json(f"{folder}/pages/landing=2")
    assert pages.landings(folder) == 2 and pages.read_pages(spark, folder).count() == 150
    pages.land_pages(some_orders(spark, 500, 510), folder, 2)
    assert pages.landings(folder) == 3 and pages.read_pages(spark, folder).count() == 160
    pages.land_pages(some_orders(spark, 500, 510), folder, 2)  # landed again: replaced
    assert pages.read_pages(spark, folder).count() == 160


@pytest.mark.parametrize("after", [None, "2024-01-20"])
def test_stream_equals_batch(spark, folder, tmp_path, after):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        (pages.stream_pages(spark, folder, after=after).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
        return rows(spark.read.parquet(out), "id", "date_created", "total")

    assert run() == rows(pages.read_pages(spark, folder, after=after), "id", "date_created", "total")
    assert run() == rows(pages.read_pages(spark, folder, after=after), "id", "date_created", "total")  # nothing new
    pages.land_pages(some_orders(spark, 150, 190, month=3), folder, 2, per_page=9)
    assert run() == rows(pages.read_pages(spark, folder, after=after), "id", "date_created", "total")


def test_offsets_name_the_same_pages_again(folder):
    reader = pages.PageStreamReader({"path": folder, "after": "2024-01-25"}, some_schema())
    start, end = reader.initialOffset(), reader.latestOffset()
    assert (start, end) == ({"landings": 0}, {"landings": 2})
    once = [p.path for p in reader.partitions(start, end)]
    assert once == [p.path for p in reader.partitions(start, end)]
    assert once == [p.path for a, b in ((0, 1), (1, 2)) for p in reader.partitions({"landings": a}, {"landings": b})]
    assert reader.partitions(end, end) == []


def test_values_of_other_types_and_broken_lines():
    schema = to_arrow_schema(some_schema())
    lines = ['{"id": 1, "total": "2.50", "new": {"a": 1}}', '{"id": "2", "total": 3.5, "line_items": [{"id": "x", "sku": 7}]}',
             '{"id": 3, "line_items": "none"}', "not json", "[1, 2]", '{"id": {"no": 1}}', ""]
    got = pages.documents("\n".join(lines).encode(), schema).to_pylist()
    assert [r["id"] for r in got] == [1, 2, 3, None, None, None]
    assert [r["total"] for r in got[:2]] == ["2.50", "3.5"]
    assert got[1]["line_items"] == [{"id": None, "name": None, "sku": "7"}] and got[2]["line_items"] is None
    even = pages.documents("\n".join(json.dumps({"id": i, "status": "s"}) for i in range(5)).encode(), schema)
    assert even.schema == schema and even.column("id").to_pylist() == list(range(5))
    assert pages.documents(b"", schema).num_rows == 0
    assert isinstance(even, pa.Table)


def test_reports_from_landed_pages(spark, sample, tmp_path):
    folder = str(tmp_path / "sample")
    pages.land_pages(sample.order_documents, folder, 0, per_page=100)
    docs = orders.typed(pages.read_pages(spark, folder))
    assert rows(orders.order_sections(docs, P.as_of)) == rows(orders.order_sections(sample.web_orders, P.as_of))
    since = str(P.back(orders.RECENT_DAYS))
    assert len(read_by_page(folder, GreaterThanOrEqual(("date_created",), since))) < len(read_by_page(folder)) / 4
