from conftest import d, item, move, n, rows
from test_stock import model

from ledgerloom.operators import purchasing, shipments, suppliers


def orders(table, lines, receipts, heads):
    return dict(
        poodt=table("poodt", *[dict(zid=z, xpornum=p, xitem=i, xqtyord=n(q), xrate=n(r)) for z, p, i, q, r in lines]),
        pogrn=table("pogrn", *[dict(zid=z, xgrnnum=g, xpornum=p, xsup="S1", xdate=d(x)) for z, g, p, x in receipts]),
        poord=table("poord", *[dict(zid=z, xpornum=p, xsup=s, xdate=d(x), xstatuspor="5-Received")
                               for z, p, s, x in heads]))


def test_last_supplier_takes_the_whole_newest_row(spark, table):
    more = orders(table, [(100002, "P1", "A-1", 1, 5), (100002, "P2", "A-1", 1, 7)], [],
                  [(100002, "P1", "S1", "2024-01-01"), (100002, "P2", "S2", "2024-02-01")])
    more["casup"] = table("casup", dict(zid=100002, xsup="S1", xshort="one", xphone="01"),
                          dict(zid=100002, xsup="S2", xshort="two", xphone=None))
    m = model(spark, table, [move()], **more)
    lines = spark.createDataFrame([(1, "done", "2024-03-01", "A-1"), (2, "done", "2024-03-01", "X-9")],
                                  "order_id bigint, status string, date_created string, sku string")
    got = rows(purchasing.last_supplier_for_orders(m, lines), "item_code", "supplier_code", "supplier_mobile",
               "last_purchase_price")
    assert got == [("A-1", "S2", "no-order-yet", n("7.00")), ("X-9", "no-order-yet", "no-order-yet", None)]


def test_order_with_two_receipts_counts_its_lines_twice(spark, table):
    more = orders(table, [(100002, "IP--1", "A-1", 3, 4), (100002, "IP--1", "A-1", 5, 6)],
                  [(100002, "G1", "IP--1", "2024-01-02"), (100002, "G2", "IP--1", "2024-01-03")],
                  [(100002, "IP--1", "S1", "2024-01-01")])
    m = model(spark, table, [move()], **more)
    assert rows(purchasing.purchase_summary(m, d("2024-01-01"))) == [(100002, "A-1", n("16.00"), 5.0)]
    assert len(rows(purchasing.purchase_receipts(m, d("2024-01-01")))) == 4
    assert rows(purchasing.purchase_receipts(m, d("2024-01-01"), after=True)) == []


def check_model(spark, table, posted):
    return model(
        spark, table,
        [move(doc="GRN-1", qty=q, zid=100001, line=i) for i, q in enumerate(posted)]
        + [move(on="2023-12-30", doc="GRN-0", qty=2, zid=100001)],
        pogrn=table("pogrn", dict(zid=100001, xgrnnum="GRN-1", xpornum="P", xsup="S", xdate=d("2024-01-01"))),
        pogdt=table("pogdt", dict(zid=100001, xgrnnum="GRN-1", xitem="A-1", xqty=n(4)),
                    dict(zid=100001, xgrnnum="GRN-1", xitem="A-1", xqty=n(6))),
        opord=table("opord"), opodt=table("opodt"))


def test_receipt_check_sums_repeated_lines_and_postings(spark, table):
    got = rows(purchasing.receipt_inventory_check(check_model(spark, table, [4, 6]), d("2024-01-01")),
               "today_grn_qty", "item_inserted_inv", "inv_rows", "yesterday_stock", "today_stock")
    assert got == [(n("10.00"), n("10.00"), 2, n("2.00"), n("12.00"))]


def test_receipt_not_posted_is_null(spark, table):
    got = rows(purchasing.receipt_inventory_check(check_model(spark, table, []), d("2024-01-01")), "item_inserted_inv")
    assert got == [(None,)]


def test_lines_without_a_code_have_no_supplier(spark, sample):
    lines = spark.createDataFrame([(1, None), (2, ""), (3, "IT-000001")], "order_id long, sku string").selectExpr(
        "order_id", "date '2001-01-01' AS date_created", "'x' AS status", "sku")
    got = {r.order_id: (r.item_code, r.supplier_code) for r in purchasing.last_supplier_for_orders(sample, lines).collect()}
    assert got[1] == (None, purchasing.NO_ORDER) and got[2] == ("", purchasing.NO_ORDER)
    assert got[3][0] == "IT-000001" and len(got) == 3


def below_an_aggregate(plan: str, table_text: str) -> bool:
    """Whether every aggregate that stands above a scan also stands above a semi join with it."""
    lines = plan.split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "Aggregate" in line:
            under = []
            for other in lines[i + 1:]:
                if depth(other) <= depth(line):
                    break
                under.append(other)
            if any("LeftSemi" in x for x in under) and any(table_text in x for x in under):
                return True
    return False


def test_semi_join_stands_below_the_sums(spark, sample):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tracking = shipments.shipment_tracking(sample, d("2001-06-30"), d("2000-06-30"))
        plan = tracking._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert below_an_aggregate(plan, "l_shipdate")


def test_sales_total_counts_an_item_once(spark, table):
    m = model(spark, table, [
        move(on="2024-01-02", doc="GRN-1", qty=10, val=50, zid=100001),
        move(on="2024-01-03", doc="GRN-2", qty=10, val=70, zid=100001),
        move(on="2024-01-04", doc="CO--1", qty=4, zid=100001)])
    got = rows(purchasing.sales_of_purchase(m, d("2024-01-01")), "purchase_rate", "stock", "sales_qty",
               "purchase_total", "sales_total")
    assert [r[1:] for r in got] == [(n(16), n(-4), n(120), n(40))] * 2
    legacy = rows(purchasing.sales_of_purchase(m, d("2024-01-01"), legacy_totals=True), "sales_total")
    assert legacy == [(n(80),)] * 2
    summary = rows(purchasing.sales_of_purchase_summary(m, d("2024-01-01")), "sales_percent")
    assert summary == [(-100 * 40 / 120,)]


def shipment_model(spark, table, extra=(), rate=4):
    more = orders(table, [(100002, "IP--1", "A-1", 20, rate), (100002, "IP--1", "B-1", 8, 2),
                          (100001, "PO-9", "A-1", 6, 9)],
                  [(100002, "GRN-1", "IP--1", "2024-01-10"), (100001, "GRN-7", "PO-9", "2024-01-11")],
                  [(100002, "IP--1", "S1", "2024-01-05"), (100001, "PO-9", "S1", "2024-01-11")])
    moves = [
        move("A-1", "2024-01-09", "TO--0", 100), move("A-1", "2024-01-10", "GRN-1", 20),
        move("A-1", "2024-01-10", "TO--1", 3), move("A-1", "2024-01-15", "TO--2", 5),
        move("A-1", "2024-01-16", "SRE-1", 1), move("A-1", "2024-01-11", "GRN-7", 6, zid=100001),
        move("A-1", "2024-01-20", "CO--1", 2, zid=100001), move("A-1", "2024-01-21", "PRE-1", 1, zid=100001),
        move("A-1", "2024-03-01", "TO--9", 50), move("B-1", "2024-01-12", "CO--2", 1, zid=100003), *extra]
    items = [item("A-1", 100002, 6), item("A-1", 100001, 9), item("A-1", 100003, 9),
             item("B-1", 100002, 3), item("B-1", 100001, 5), item("B-1", 100003, 4)]
    return model(spark, table, moves, items, **more)


def test_shipment_counts_from_the_receipt_day_on(spark, table):
    t = shipments.shipment_tracking(shipment_model(spark, table), d("2024-02-01"), d("2024-01-01"))
    got = rows(t, "xitem", "cpqty", "transfer", "creturn", "cstock", "gpurchase", "gsales", "gpreturn", "gstock",
               "esales")
    assert got == [
        ("A-1", n(20), n(8), n(1), n(-87), n(6), n(2), n(1), n(3), n(0)),
        ("B-1", n(8), n(0), n(0), n(0), n(0), n(0), n(0), n(0), n(1))]
    checks = rows(t.filter("xitem = 'A-1'"), "central_check", "store_check", "total_cpgp", "total_rgp", "total_ggp")
    assert checks == [(n(20 - 8 + 87 + 1), n(0), n(40), n(60), n(6))]


def test_shipment_errors_and_zero_stock(spark, table):
    t = shipments.shipment_tracking(shipment_model(spark, table), d("2024-02-01"), d("2024-01-01"))
    errors = {(r[0], r[1]) for r in rows(shipments.shipment_errors(t), "xitem", "check_name")}
    # B-1 has other prices in the shop, no stock in central, and no stock left in the shop
    assert errors == {("A-1", "central_check"), ("B-1", "central_check"), ("B-1", "store_price_check")}
    assert rows(shipments.shipment_zero_stock(t), "xitem") == [("B-1",)]
    assert len(rows(shipments.shipment_summary(t))) == 9


def test_shipment_with_zero_rate_has_no_price_check(spark, table):
    t = shipments.shipment_tracking(shipment_model(spark, table, rate=0), d("2024-02-01"), d("2024-01-01"))
    assert rows(t.filter("xitem = 'A-1'"), "price_check") == [(None,)]


def test_shipment_window_sees_days_not_movements(spark, table):
    """Many movements of one item on one day are one row for the running total."""
    hot = [move("A-1", "2024-01-25", "CO--5", 1, zid=100001, line=i) for i in range(300)]
    t = shipments.shipment_tracking(shipment_model(spark, table, hot), d("2024-02-01"), d("2024-01-01"))
    assert rows(t.filter("xitem = 'A-1'"), "gsales") == [(n(302),)]


def test_missing_store_stock_keeps_central_stock(spark, table):
    more = orders(table, [], [(100002, "GRN-1", "P", "2024-01-01")], [])
    more["pogdt"] = table("pogdt", dict(zid=100002, xgrnnum="GRN-1", xitem="A-1", xqty=n(1)))
    m = model(spark, table, [move(qty=4, val=10)], **more)
    listed = spark.createDataFrame([("S1",)], "xsup string")
    none = spark.createDataFrame([], "xsup string")
    credit = suppliers.credit_supplier_detail(m, listed, d("2024-01-31"))
    assert rows(credit, "xsup", "total_stock", "purchase_rate") == [("S1", n(4), n("2.5000"))]
    assert rows(suppliers.credit_supplier_financials(credit), "inventory_purchase_value") == [(n(10),)]
    assert rows(suppliers.rest_supplier_detail(m, listed, d("2024-01-31"))) == []
    rest = suppliers.rest_supplier_detail(m, none, d("2024-01-31"))
    assert rows(rest, "xsup", "total_stock") == [("S1", n(4))]
