import pyspark.sql.functions as F
from conftest import d, move, n, rows
from test_stock import model

from ledgerloom.operators import profit

A, B = d("2024-01-01"), d("2024-12-31")


def sales_model(spark, table, moves, lines):
    return model(
        spark, table, moves,
        opodt=table("opodt", *[dict(zid=100001, xordernum=o, xitem=i, xqtyord=n(1), xlineamt=n(a), xdtwotax=n(a),
                                    xdtdisc=n(1)) for o, i, a in lines]),
        opord=table("opord", *[dict(zid=100001, xordernum=o, xdate=A) for o in {x[0] for x in lines}]),
        imtdt=table("imtdt"), imtor=table("imtor"),
        imtemptdt=table("imtemptdt", dict(zid=100001, ximtrnnum="SRE-1", xitem="A-1", xrate=n(3))),
        imtemptrn=table("imtemptrn", dict(zid=100001, ximtmptrn="SRE-1")))


def test_repeated_item_joins_every_line_with_every_movement(spark, table):
    moves = [move(doc="CO--1", qty=2, val=10, zid=100001, line=1), move(doc="CO--1", qty=3, val=15, zid=100001, line=2)]
    m = sales_model(spark, table, moves, [("CO--1", "A-1", 20), ("CO--1", "A-1", 30), ("CO--1", "A-1", 50)])
    pairs = (m.imtrn.join(m.opodt.withColumnRenamed("xordernum", "xdocnum"), ["zid", "xdocnum", "xitem"])
             .agg(F.count("*"), F.sum(F.expr("xqty * xsign")), F.sum(F.expr("xval * xsign")), F.sum("xlineamt"),
                  F.sum(F.expr("xdtwotax - xdtdisc"))).first())
    got = rows(profit.sales_cogs(m, A, B), "n_pairs", "qty", "totalvalue", "xlineamt", "xdtwotax")
    assert got == [tuple(pairs)] == [(6, n(-15), n(-75), n(200), n(194))]


def test_document_type_is_contained_not_only_leading(spark, table):
    moves = [move(doc="XCO--1", qty=1, val=5, zid=100001), move(doc="CO-2", qty=1, val=5, zid=100001)]
    m = sales_model(spark, table, moves, [("XCO--1", "A-1", 9), ("CO-2", "A-1", 9)])
    assert rows(profit.sales_cogs(m, A, B), "xdocnum") == [("XCO--1",)]


def test_profit_subtracts_returns_and_adds_a_total(spark, table):
    moves = [move(doc="CO--1", qty=2, val=10, zid=100001), move("B-1", doc="CO--2", qty=1, val=4, zid=100001),
             move(doc="SRE-1", qty=2, val=6, zid=100001)]
    m = sales_model(spark, table, moves, [("CO--1", "A-1", 20), ("CO--2", "B-1", 5)])
    got = rows(profit.item_profit(m, A, B), "xitem", "xdesc", "totalvalue", "final_sales", "gross_profit")
    assert got == [("A-1", "thing", n(-10), n(14), n(4)), ("B-1", "thing", n(-4), n(5), n(1)),
                   (None, "Total_Item_Profit", n(-14), n(19), n(5))]
    ratio = rows(profit.group_profit_ratio(m, A, B), "xgitem", "profit_ratio")
    assert ratio == [("G", 500 / 14)]


def test_total_row_is_the_sum_of_the_items(sample):
    df = profit.item_profit(sample, d("2000-01-01"), d("2001-06-30")).cache()
    total = df.filter("xitem is null").groupBy("zid").agg(F.sum("gross_profit").alias("g"))
    items = df.filter("xitem is not null").groupBy("zid").agg(F.sum("gross_profit").alias("g"))
    assert rows(total) == rows(items)


def test_unit_without_sales_stays_in_the_summary(spark, sample):
    none = sample.replace(imtrn=sample.imtrn.filter("zid <> 100003"))
    got = {r[0]: r[1:] for r in rows(profit.business_profit_summary(none, d("1992-01-01"), d("2001-06-30")),
                                     "zid", "gross_profit", "expenditure_gl", "net")}
    assert set(got) == {100001, 100002, 100003}
    assert got[100003][0] == 0 and got[100003][2] == -got[100003][1]
