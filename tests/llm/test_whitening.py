"""Whitening against another eigensolver and exact sums in Python."""

import math

import duckdb
import numpy as np
import pytest
from conftest import SAMPLE
from pyspark.sql import functions as F

from ledgerloom.llm import whitening


@pytest.fixture(scope="module")
def vectors():
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SAMPLE}/embeddings.parquet'").fetchall()
    return {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)}


def test_query_on_the_whole_sample(spark, vectors):
    got = whitening.op11_embedding_whitening(spark, SAMPLE).toPandas()
    n, ids = len(vectors), sorted(vectors)
    x = np.array([vectors[i] for i in ids])
    sums = [sum(c) for c in zip(*vectors.values())]
    assert len(got) == 32 * n and set(got.n) == {n} and set(got.component) == set(range(1, 33))
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for i, v in vectors.items()}
    assert all(deviation[i] == d for i, d in zip(got.vec_id, got.deviation))
    centred = (n * x - np.array(sums)) / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1]
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    want = centred @ components[:, :32] / np.sqrt(values[:32])
    signs = np.sign((wide * want).sum(0))
    assert np.abs(wide - want * signs).max() < 1e-8
    shares = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(shares, values[:32] / values.sum(), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error[0] < 1e-9
    assert np.abs(wide.T @ wide / n - np.eye(32)).max() < 1e-9


@pytest.mark.parametrize(("size", "rank"), [(1, 1), (2, 1), (7, 7), (20, 5), (33, 33)])
def test_factor_and_rotations(size, rank):
    rng = np.random.default_rng(size)
    half = rng.normal(size=(size, rank)) * 10.0 ** rng.uniform(-3, 3, size=rank)
    matrix = half @ half.T
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape[1] <= rank and np.abs(factor @ factor.T - matrix).max() <= 1e-12 * matrix.max()
    order = np.argsort([np.flatnonzero(row)[-1] if row.any() else size for row in factor], kind="stable")
    assert np.allclose(np.triu(factor[order][:factor.shape[1]], 1), 0)
    values, components = whitening.one_sided_jacobi(factor)
    assert list(values) == sorted(values, reverse=True)
    assert np.allclose(components.T @ components, np.eye(len(values)), atol=1e-13)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:len(values)], rtol=1e-9, atol=1e-13 * values[0])


def test_no_rank_no_components():
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    assert whitening.one_sided_jacobi(np.zeros((3, 0)))[0].shape == (0,)


def test_exact_numbers_beyond_a_long():
    x = np.array([[1 << 61, -5]])
    assert whitening.exact_deviations(x, 9, [7, 2]).tolist() == [[9 * (1 << 61) - 7, -47]]
    assert whitening.squared_length(np.array([[1 << 40, 3], [4, 3]])) == [None, 25]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, 3.0]), (2, [0.5, -1.0, 3.0]), (2, [0.5, -1.0, 3.0]), (None, [0.25, 4.0, 3.0]), (3, None), (4, []),
            (5, [1.0, None, 2.0]), (6, [nan, 1.0, 2.0]), (7, [1.0, inf, 2.0]), (8, [1.0, 2.0]), (9, [1e300, 1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("whitening", F.lit("mine")).withColumn("n", F.lit(0))
    got = whitening.whiten(df).collect()
    assert sorted(str(r.vec_id) for r in got) == ["1", "2", "2", "None"]
    x = np.array([[math.floor(64 * c) for c in v] for i, v in rows if i in (1, 2, None)])
    centred = x - x.mean(0)
    assert all(r.whitening.n == 4 and len(r.whitening.whitened) == 2 for r in got)
    by = {r.vec_id: r.whitening for r in got}
    assert by[1].deviation == int(((4 * x - x.sum(0)) ** 2)[0].sum())
    values = np.linalg.eigvalsh(centred.T @ centred / 4)[::-1]
    assert np.allclose(by[1].explained, values[:2] / values.sum()) and by[1].identity_error < 1e-9
    assert np.allclose(sorted(abs(np.array(by[2].whitened))), sorted(abs(np.array(got[[r.vec_id for r in got].index(2)].whitening.whitened))))
    assert whitening.whiten(df.where("false")).count() == 0
    assert whitening.whiten(df.where("vec_id = 3")).count() == 0
    for alone in ("vec_id = 1", "vec_id = 2"):  # one vector, or equal ones, span nothing
        assert [list(r.whitening.whitened) for r in whitening.whiten(df.where(alone)).collect()] in ([[]], [[], []])


def test_whole_entries_of_another_type(spark):
    df = spark.createDataFrame([(i, [i % 5, i % 7]) for i in range(50)], "vec_id long, embedding array<int>")
    assert len(whitening.whiten(df).first().whitening.whitened) == 2
