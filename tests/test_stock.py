from conftest import d, item, move, n, rows

from ledgerloom.model import Model
from ledgerloom.operators import stock


def model(spark, table, moves, items=None, **more):
    items = items or [item(c, z) for c in {m["xitem"] for m in moves} for z in (100001, 100002, 100003)]
    frames = {"imtrn": table("imtrn", *moves), "caitem": table("caitem", *items),
              "tenant": table("tenant", dict(zid=100001, name="store"), dict(zid=100002, name="central"),
                              dict(zid=100003, name="ecommerce")), **more}
    return Model(spark, {}).replace(**frames)


def test_newest_movement_breaks_ties_by_document(spark, table):
    m = model(spark, table, [move(doc="GRN-1", qty=2, val=8), move(doc="GRN-2", qty=5, val=9),
                             move(on="2023-12-31", doc="GRN-9", qty=7)])
    assert rows(stock.last_movement(m), "xdocnum", "xqty") == [("GRN-2", n("5.00"))]
    assert rows(stock.last_movement(m, "CO--")) == []


def test_zero_quantity_has_no_rate(spark, table):
    m = model(spark, table, [move(zid=100002, qty=3), move(zid=100001, qty=0, val=5)])
    assert rows(stock.inventory_report(m), "inventory", "xrate") == [(n("3.00"), None)]


def test_warehouse_without_name_is_not_counted(spark, table):
    config = table("tenant_config", dict(zid=100002, cogs_account="1", warehouse_text="Main"))
    m = model(spark, table, [move(val=10, wh="Main 1"), move(val=5, wh=None), move(val=7, wh="Annex")],
              tenant_config=config)
    assert rows(stock.inventory_value_totals(m, d("2024-01-31")), "zid", "value") == [(100002, n("10.00"))]
    by_room = rows(stock.inventory_value_by_warehouse(m, d("2024-01-31")), "value")
    assert sum(r[0] for r in by_room) == n("22.00")


def test_negative_movement_looks_at_last_quantity_not_balance(spark, table):
    m = model(spark, table, [
        move("A-1", qty=10), move("A-1", on="2024-01-02", qty=-1),
        move("B-1", qty=1, doc="CO--1")])
    assert rows(stock.negative_movements(m), "xitem") == [("A-1",)]
    assert rows(stock.negative_movements(m, on="balance"), "xitem") == [("B-1",)]


def test_branches_cut_fractions_and_need_central(spark, table):
    m = model(spark, table, [
        move("A-1", qty="2.90"), move("A-1", zid=100001, qty="1.50", doc="CO--1"),
        move("B-1", zid=100001, qty=4)])
    assert rows(stock.multi_branch_stock(m)) == [("A-1", "thing", 2, -1, 0, 1)]


def snapshot(spark, *pairs):
    return spark.createDataFrame(
        [(s, "x", c, 0, 0, c) for s, c in pairs],
        "sku string, name string, central bigint, store bigint, ecommerce bigint, sum_of_stock bigint")


def test_changes_include_unknown_yesterday(spark):
    now = snapshot(spark, ("new", 1), ("same", 2), ("moved", 3))
    before = snapshot(spark, ("same", 2), ("moved", 4), ("gone", 5))
    assert rows(stock.stock_changes(now, before), "sku", "previous") == [("moved", 4), ("new", None)]


def test_shipping_class_rules(spark):
    schema = "sku string, name string, central bigint, store bigint, ecommerce bigint, sum_of_stock bigint"
    now = spark.createDataFrame([("c", "x", 5, 0, 0, 5), ("s", "x", 1, 1, 0, 2), ("z", "x", 0, 0, 0, 0),
                                 ("k", "x", 1, 0, 0, 1)], schema)
    before = now.filter("sku = 'k'")
    products = spark.createDataFrame(
        [(1, "c", "inhouse"), (2, "s", "nearby"), (3, "z", ""), (4, "k", "inhouse"), (5, "k", ""),
         (6, "", ""), (7, "unknown", ""), (8, "", "nearby"), (9, None, None)],
        "id bigint, sku string, shipping_class string")
    assert rows(stock.shipping_class(products, now, before)) == [
        (1, "nearby"), (2, "inhouse"), (3, "nothouse"), (5, "nearby"), (6, "nothouse"), (7, "nothouse"),
        (9, "nothouse")]


def test_sync_can_drop_empty_stock(spark):
    now = snapshot(spark, ("a", 0), ("b", 3))
    products = spark.createDataFrame([(1, "a"), (2, "b"), (0, "b"), (3, "")], "id bigint, sku string")
    assert rows(stock.stock_quantity_sync(products, now)) == [(1, 0, True), (2, 3, True)]
    assert rows(stock.stock_quantity_sync(products, now, drop_zero=True)) == [(2, 3, True)]


def test_warehouse_sums_equal_item_sums(sample):
    import pyspark.sql.functions as F
    by_room = stock.inventory_value_by_warehouse(sample, d("2001-06-30")).agg(F.sum("value")).first()[0]
    moved = sample.imtrn.filter("xdate <= date'2001-06-30'").agg(F.sum(F.expr("xval * xsign"))).first()[0]
    assert by_room == moved


def test_one_hot_item_is_summed_before_it_moves(spark, sample):
    """The plan aggregates partially, and ranks nothing over raw movements."""
    plan = stock.last_movement(sample)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_receipt_type_reaches_the_scan(sample):
    plan = stock.last_movement(sample, "GRN-")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_linestatus,F)" in plan


def test_sample_has_negative_movements(sample):
    assert stock.negative_movements(sample).count() > 0
