"""Consecutive numbers: the input is worked out once, whatever gaps its keys have."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerloom.functions.numbering import dense_numbers
from ledgerloom.sources.sinks import update_batches


def counted(spark, df):
    """``df`` with every evaluation of a row counted."""
    seen = spark.sparkContext.accumulator(0)

    def look(key):
        seen.add(1)
        return key

    return df.withColumn("id", F.udf(look, LongType()).asNondeterministic()("id")), seen


@pytest.mark.parametrize("gap", [1, 1 << 32])
def test_the_input_is_worked_out_once(spark, gap):
    df, seen = counted(spark, spark.range(0, 1000 * gap, gap).repartition(5))
    got = dense_numbers(df, "id", ranges=16).collect()
    assert sorted((r.id, r.rn) for r in got) == [(i * gap, i + 1) for i in range(1000)]
    assert seen.value == 1000


def test_payloads_work_their_input_out_once(spark):
    df, seen = counted(spark, spark.range(250).selectExpr("id", "id * 2 AS stock_quantity"))
    got = update_batches(df, 100).collect()
    assert sorted((r.batch, r.n_rows, r.first_id, r.last_id) for r in got) == [(0, 100, 0, 99), (1, 100, 100, 199), (2, 50, 200, 249)]
    assert seen.value == 250


def test_numbers_in_groups_with_crowded_and_distant_keys(spark):
    rows = [(g, (1 << 40) * (i % 3) + i) for g in range(3) for i in range(200 if g else 900)]
    df, seen = counted(spark, spark.createDataFrame(rows, "g int, id long").repartition(3))
    got = dense_numbers(df, "id", ("g",), ranges=8).collect()
    for g in range(3):
        own = sorted((r.id, r.rn) for r in got if r.g == g)
        assert [rn for _, rn in own] == list(range(1, len(own) + 1))
    assert seen.value == len(rows)
