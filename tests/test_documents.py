"""Documents that drift: kept whole, or set aside with a reason; none is lost."""

import json

import pytest
from conftest import rows

from ledgerloom.operators import orders
from ledgerloom.sources import documents as docs

GOOD = [
    {"id": 1, "status": "done", "date_created": "2024-01-01T10:00:00", "total": "2.50", "line_items": [{"id": 7, "sku": "A", "price": 3}]},
    {"id": "2", "total": 3.5, "line_items": [], "coupon": {"code": "C"}, "tags": [1, "x"]},
    {"id": 3, "total": "", "date_created": None, "status": None},
]
BAD = [
    ('{"id": 4, "total": "1"', "not JSON"), ("[1, 2]", "not an object"), ("7", "not an object"), ("", "not JSON"),
    ('{"status": "x"}', "id: missing"), ('{"id": null}', "id: missing"), ('{"id": "A9"}', "id: not bigint"),
    ('{"id": 5, "total": "much", "date_created": "soon"}', "date_created: not timestamp_ntz; total: not decimal"),
    ('{"id": 6, "line_items": "none"}', "line_items: not array"), ('{"id": 7, "id": 8}', "not JSON"),
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(json.dumps(g),) for g in GOOD] + [(b,) for b, _ in BAD], "value string").repartition(3)


def test_every_line_is_kept_or_set_aside(spark, lines, tmp_path):
    folder = str(tmp_path / "d")
    docs.land_documents(lines, folder, 0, docs.ORDER)
    kept, rejects = docs.read_documents(spark, folder, docs.ORDER), docs.read_rejects(spark, folder)
    assert kept.count() + rejects.count() == lines.count()
    assert sorted((r.line, r.reason) for r in rejects.collect()) == sorted(BAD)
    by = {r.id: r for r in kept.collect()}
    assert by[1].line_items[0].sku == "A" and by[1].more is None
    assert by[2].total == "3.5" and json.loads(by[2].more) == {"coupon": {"code": "C"}, "tags": [1, "x"]}
    assert by[3].status is None and by[3].date_created is None


def test_what_is_unknown_today_can_be_read_tomorrow(spark, lines, tmp_path):
    folder = str(tmp_path / "d")
    docs.land_documents(lines, folder, 0, docs.ORDER)
    wider = docs.Kind({**docs.ORDER.fields, "coupon": "struct<code: string>"})
    by = {r.id: r for r in docs.read_documents(spark, folder, wider).collect()}
    assert by[2].coupon.code == "C" and json.loads(by[2].more) == {"tags": [1, "x"]} and by[1].coupon is None


def test_a_landing_run_again_replaces_its_own(spark, lines, tmp_path):
    folder = str(tmp_path / "d")
    docs.land_documents(lines, folder, 0, docs.ORDER)
    docs.land_documents(lines, folder, 1, docs.ORDER)
    docs.land_documents(lines, folder, 1, docs.ORDER)
    assert docs.read_rejects(spark, folder).count() == 2 * len(BAD)
    assert docs.read_documents(spark, folder, docs.ORDER).count() == 2 * len(GOOD)
    docs.land_documents(lines.where("false"), folder, 2, docs.ORDER)
    assert docs.read_documents(spark, folder, docs.ORDER).count() == 2 * len(GOOD)


def test_a_repaired_reject_lands_like_any_line(spark, lines, tmp_path):
    folder = str(tmp_path / "d")
    docs.land_documents(lines, folder, 0, docs.ORDER)
    mended = docs.read_rejects(spark, folder).where("reason = 'id: not bigint'").selectExpr("replace(line, 'A9', '9') AS value")
    docs.land_documents(mended, folder, 1, docs.ORDER)
    assert 9 in {r.id for r in docs.read_documents(spark, folder, docs.ORDER).collect()}


def test_products_drift_too(spark, tmp_path):
    lines = spark.createDataFrame([('{"id": 1, "sku": 77, "regular_price": 9.5, "stock": 3}',), ('{"sku": "A"}',)], "value string")
    docs.land_documents(lines, str(tmp_path / "p"), 0, docs.PRODUCT)
    assert rows(docs.read_documents(spark, str(tmp_path / "p"), docs.PRODUCT), "id", "sku", "regular_price", "more") == [
        (1, "77", "9.5", '{"stock":3}')]


def test_only_the_asked_fate_is_read(spark, lines, tmp_path):
    folder = str(tmp_path / "d")
    docs.land_documents(lines, folder, 0, docs.ORDER)
    for df, fate in ((docs.read_rejects(spark, folder), "rejected"), (docs.read_documents(spark, folder, docs.ORDER), "kept")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert f"= {fate})" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_order_lines_of_the_sample(spark, sample, tmp_path):
    folder = str(tmp_path / "s")
    sent = sample.document_lines
    docs.land_documents(sent, folder, 0, docs.ORDER)
    kept = docs.read_documents(spark, folder, docs.ORDER)
    assert kept.count() + docs.read_rejects(spark, folder).count() == sent.count()
    whole = orders.order_lines(sample.web_order_documents).where("order_id % 101 <> 0 AND order_id % 103 <> 0 AND order_id % 107 <> 0")
    assert rows(orders.order_lines(kept)) == rows(whole)


def test_a_value_is_read_once(spark):
    """Reading a value from VARIANT is what judging costs."""
    lines = spark.createDataFrame([('{"id": 1}',)], "value string")
    plan = docs.judge(lines, docs.ORDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") == len(docs.ORDER.fields)
