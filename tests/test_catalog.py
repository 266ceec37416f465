from datetime import datetime

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions.numbering import dense_numbers
from ledgerloom.model import Model
from ledgerloom.operators import catalog
from ledgerloom.schemas import ITEM_COLUMNS


def items(spark, *codes):
    return spark.createDataFrame([(1, c, "old", "G", "B", 5) for c in codes],
                                 "zid int, xitem string, xdesc string, xgitem string, xbrand string, xstdprice int")


def sheet(spark, *entries):
    return spark.createDataFrame(
        [(1, code, f"row {i}", "H", None, 9, i) for i, code in enumerate(entries)],
        "zid int, xitem string, xdesc string, xgitem string, xbrand string, xstdprice int, row_id bigint")


def test_numbers_continue_after_the_largest_suffix(spark):
    known = items(spark, "AB-7", "AB-12", "AB-x9", "AB-12-99", "ABC-50")
    new = sheet(spark, "AB-", "ZZ-", "AB-", "AB")
    got = rows(catalog.generate_item_codes(new, known), "row_id", "new_code")
    # the prefix "AB" also covers ABC-50
    assert got == [(0, "AB-13"), (1, "ZZ-1"), (2, "AB-14"), (3, "AB51")]


def test_no_new_rows_give_no_codes(spark):
    assert rows(catalog.generate_item_codes(sheet(spark), items(spark, "A-1"))) == []


def test_missing_attribute_is_no_code(spark):
    codes = rows(catalog.attribute_codes(sheet(spark, "A-1", "A-2")))
    assert codes == []
    tagged = spark.createDataFrame([(1, "Blue", "U1"), (1, "Blue", None)], "zid int, xcolor string, xeccrange string")
    assert rows(catalog.attribute_codes(tagged)) == [(1, "Color", "Blue"), (1, "Measurement Unit 1", "U1")]
    known = spark.createDataFrame([(1, "Color", "Blue"), (2, "Measurement Unit 1", "U1")],
                                  "zid int, xtype string, xcode string")
    assert rows(catalog.missing_codes(tagged, known)) == [(1, "Measurement Unit 1", "U1")]


def test_upsert_replaces_appends_and_keeps(spark):
    known = items(spark, "A-1", "A-2")
    listed = sheet(spark, "A-1", "N-", "A-1")
    got = rows(catalog.catalog_upsert(known, listed), "xitem", "xdesc", "xgitem", "xbrand", "action")
    # the first sheet row wins, an empty cell empties the attribute, the group stays
    assert got == [("A-1", "row 0", "G", None, "updated"), ("A-2", "old", "G", "B", "kept"),
                   ("N-1", "row 1", "H", None, "inserted")]


def test_upsert_of_stored_items_loses_no_column(spark, sample, tmp_path):
    """Attributes, also those that no sheet changes, survive a round through stored tables."""
    sample.caitem.selectExpr(*[f"cast({c} AS {kind}) AS {c}" for c, kind in ITEM_COLUMNS.items()]).write.parquet(
        str(tmp_path / "caitem"))
    stored = Model.from_tables(spark, str(tmp_path)).caitem
    assert set(stored.columns) == set(ITEM_COLUMNS) and len(ITEM_COLUMNS) == 44
    after = catalog.catalog_upsert(stored, sample.catalog_sheet, warehouse="Room", ts=datetime(2024, 1, 2))
    assert after.columns == [*stored.columns, "action"]
    kept = after.filter("action = 'kept'").drop("action")
    assert kept.exceptAll(stored).isEmpty()
    one = after.filter("action = 'inserted'").first()
    assert (one.xcatful, one.xwh, one.xcfiss, one.ztime) == ("Auto", "Room", 1, datetime(2024, 1, 2))
    changed = after.filter("action = 'updated' AND xlong LIKE 'new %'").first()
    assert changed.xremark is None or changed.xremark.startswith("old")


def test_existing_and_new_make_the_sheet(sample):
    central = sample.caitem.filter("zid = 100002")
    listed = sample.catalog_sheet
    old, new = catalog.catalog_existing(listed, central), catalog.catalog_new(listed, central)
    assert old.count() + new.count() == listed.count()
    assert catalog.catalog_upsert(sample.caitem, listed).count() == sample.caitem.count() + new.count()


def test_defaults(spark):
    got = catalog.new_item_defaults(sheet(spark, "N-"), "Room", datetime(2024, 1, 2, 3, 4, 5))
    assert rows(got, "xcatful", "xtypestk", "xwh", "xcfiss", "ztime") == [
        ("Auto", "Stock-N-Sell", "Room", 1, datetime(2024, 1, 2, 3, 4, 5))]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.sets(st.integers(-5_000_000, 5_000_000), min_size=1, max_size=60), ranges=st.integers(1, 70))
def test_dense_numbers_equal_a_plain_sort(spark, keys, ranges):
    df = spark.createDataFrame([(k, k % 2) for k in keys], "k bigint, g bigint")
    whole = {r.k: r.rn for r in dense_numbers(df, "k", ranges=ranges).collect()}
    assert whole == {k: i for i, k in enumerate(sorted(keys), start=1)}
    grouped = {(r.g, r.k): r.rn for r in dense_numbers(df, "k", by=("g",), ranges=ranges).collect()}
    for g in (0, 1):
        part = sorted(k for k in keys if k % 2 == g)
        assert [grouped[(g, k)] for k in part] == list(range(1, len(part) + 1))


def test_numbers_of_keys_far_apart(spark):
    keys = [i * 2 ** 32 for i in range(-20_000, 20_000)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(4)
    numbered = dense_numbers(df, "k")
    assert numbered.agg(F.count_distinct("rn"), F.min("rn"), F.max("rn")).first() == (40_000, 1, 40_000)
    assert numbered.where("k <> (rn - 20001) * 4294967296").isEmpty()
    assert "Window" not in "".join(x for x in numbered._jdf.queryExecution().optimizedPlan().toString().split("\n")
                                   if "Window" in x and "_bucket" not in x)
