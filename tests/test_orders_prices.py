import json

from conftest import d, n, rows

from ledgerloom.operators import orders, pricing
from ledgerloom.sources.sinks import update_batches

ORDERS = "id bigint, status string, date_created string, date_completed string, total string"


def frame(spark, *entries):
    return spark.createDataFrame(list(entries), ORDERS)


def test_bad_dates_and_unknown_statuses(spark):
    df = frame(spark, (1, "completed", "2024-01-10T10:00:00", None, "5.00"),
               (2, "processing", "not a date", None, "1"), (3, "mystery", "2024-01-10T10:00:00", None, "1"))
    assert rows(orders.orders_in_scope(df, d("2024-01-12")), "id") == [(1,)]
    aged = rows(orders.order_age(df, d("2024-01-12")), "id", "days_for_order", "days_pass_order")
    # completed without a completion date still ages until today
    assert aged == [(1, 2, "completed within 2 days"), (2, None, None), (3, 2, "2 days pass after created")]
    labels = rows(orders.order_status_label(df), "now_status")
    assert labels == [("Order Completed",), ("mystery",), ("processing",)]


def test_each_status_looks_back_its_own_days(spark):
    df = frame(spark, (1, "completed", "2024-01-01T00:00:00", None, "1"),
               (2, "processing", "2014-01-01T00:00:00", None, "1"),
               (3, "order-cancelled", "2024-01-08T00:00:00", None, "1"),
               (4, "processing", "2024-02-01T00:00:00", None, "1"))
    assert rows(orders.orders_in_scope(df, d("2024-01-12")), "id") == [(2,), (3,)]


def test_empty_sections_are_shown(spark):
    df = frame(spark, (1, "processing", "2024-01-10T10:00:00", None, "5.25"),
               (2, "processing", "2024-01-09T10:00:00", None, "1"))
    full = rows(orders.order_sections_complete(df, d("2024-01-12")), "section", "n_orders", "total", "note")
    assert len(full) == 8
    assert full[0] == (1, 2, n("6.25"), None) and full[1][1:] == (0, 0, "no orders")
    detail = [r.id for r in orders.order_section_detail(df, d("2024-01-12")).collect()]
    assert detail == [2, 1]


def test_lines_of_nested_orders(spark):
    df = spark.createDataFrame(
        [(1, "done", "2024-01-02T00:00:00", [(7, "a", "A-1"), (8, "b", "B-1")]), (2, "done", "2024-01-01", [])],
        "id bigint, status string, date_created string, line_items array<struct<id: bigint, name: string, sku: string>>")
    assert rows(orders.order_lines(df), "order_id", "product_id", "sku") == [(1, 7, "A-1"), (1, 8, "B-1")]
    assert rows(orders.order_lines(df, since=d("2024-01-03"))) == []


def prices(spark):
    products = spark.createDataFrame(
        [(1, "A-1", "9"), (2, "A-2", "12.5"), (3, "A-3", "abc"), (4, "A-4", ""), (5, "", "1"), (6, "A-1", None),
         (7, "X-1", "3")], "id bigint, sku string, regular_price string")
    items = spark.createDataFrame(
        [(z, f"A-{i}", n("10.75")) for z in (100001, 100003) for i in range(1, 5)],
        "zid int, xitem string, xstdprice decimal(18,2)")
    return products, items


def test_price_flags(spark):
    got = rows(pricing.price_compare(*prices(spark), 100001), "id", "web_price", "web_below_erp", "web_above_erp")
    assert got == [(1, n(9), True, False), (2, n("12.5"), False, True), (3, None, False, False), (4, None, False, False)]
    assert rows(pricing.erp_price_updates(*prices(spark))) == [("A-1", n("10.75"), n(9))]
    assert rows(pricing.erp_price_updates(*prices(spark), target="erp_truncated")) == [("A-1", n("10.75"), n(10))]
    assert rows(pricing.web_price_updates(*prices(spark))) == [(1, 10)]
    assert rows(pricing.store_cheaper(*prices(spark)), "id", "store_price") == [(2, n("10.75"))]


def test_payloads_hold_every_row_once(spark):
    changes = spark.range(0, 205).selectExpr("id * 1000003 % 1000 * 100000 + id AS id", "true AS manage_stock")
    batches = update_batches(changes, 99).orderBy("batch").collect()
    assert [b.n_rows for b in batches] == [99, 99, 7]
    sent = [u["id"] for b in batches for u in json.loads(b.payload)["update"]]
    assert sent == sorted(r.id for r in changes.collect())
    assert list(json.loads(batches[0].payload)["update"][0]) == ["id", "manage_stock"]


def test_documents_hold_several_lines(sample):
    documents = sample.web_order_documents
    sizes = documents.selectExpr("size(line_items) AS n").groupBy().agg({"n": "max"}).first()[0]
    assert sizes > 1
    lines = orders.order_lines(documents)
    assert lines.count() == sample.imtrn.count()
