"""Embedding whitening by a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries are turned into whole numbers, so the count and the sums of the list
are exact and a vector is centred exactly before it is multiplied.  Tasks
reduce their rows to one triangle of products; the triangles are added up by
Spark and one matrix, whatever the number of rows, is factored on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, ship, table

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: An entry times ``SCALE`` stays below this, so that it and its square sums are whole numbers of a long or a Python int.
LARGEST = float(1 << 62)
LONG = 1 << 63
FIELDS = "deviation long, whitened array<double>"


# --- the matrix, on the driver

def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L with L L' = ``matrix``, lower triangular in the order of the pivots; a column per rank.

    Rows stay in the order of the dimensions.  The largest remaining diagonal
    entry is the next pivot; what is left below rounding is rank that is not there.
    """
    size = len(matrix)
    left = np.diag(matrix).astype(np.float64).copy()
    factor = np.zeros((size, size))
    floor = size * np.finfo(np.float64).eps * max(left.max(initial=0.0), 0.0)
    open_rows = np.ones(size, bool)
    for k in range(size):
        pivot = int(np.argmax(np.where(open_rows, left, -np.inf)))
        if not left[pivot] > floor:
            return factor[:, :k]
        open_rows[pivot] = False
        column = (matrix[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / np.sqrt(left[pivot])
        column[pivot] = np.sqrt(left[pivot])
        column[~open_rows & (np.arange(size) != pivot)] = 0.0  # rows of earlier pivots are done
        factor[:, k] = column
        left -= column * column
    return factor


def _rounds(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of pairs without a common column (a tournament)."""
    players = list(range(size + size % 2))
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(a, b) for a, b in zip(players[:half], players[:half - 1:-1]) if a < size and b < size]
        if pairs:
            yield np.array([min(p) for p in pairs]), np.array([max(p) for p in pairs])
        players = [players[0], players[-1], *players[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components in columns) of L L', by falling eigenvalue.

    Columns of L are rotated in pairs until all are orthogonal; then their
    squared lengths are the eigenvalues, and at unit length they are the
    eigenvectors.  L L' itself is never formed, so small ones keep their digits.
    """
    g = factor.astype(np.float64).copy()
    enough = max(1, g.shape[0]) * np.finfo(np.float64).eps
    for _ in range(sweeps):
        rotated = False
        for p, q in _rounds(g.shape[1]):
            a, b = g[:, p], g[:, q]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            turn = np.abs(gamma) > enough * np.sqrt(alpha * beta)
            if not turn.any():
                continue
            rotated = True
            p, q, a, b = p[turn], q[turn], a[:, turn], b[:, turn]
            zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1 / np.hypot(1.0, tangent)
            g[:, p], g[:, q] = cosine * a - cosine * tangent * b, cosine * tangent * a + cosine * b
        if not rotated:
            break
    values = (g * g).sum(0)
    order = np.argsort(-values, kind="stable")
    values = values[order]
    return values, g[:, order] / np.sqrt(values)


# --- rows to whole numbers, inside tasks

def _whole(entries: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * entries).astype(np.int64) + OFFSET


def exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as longs where they fit, else as Python numbers."""
    reach = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums), default=0)
    if reach < LONG:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squared_length(deviations: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exactly; None where a long cannot hold it."""
    reach = max(abs(int(deviations.max(initial=0))), abs(int(deviations.min(initial=0))))
    if reach * reach * deviations.shape[1] < LONG:
        return (deviations * deviations).sum(1).tolist()
    exact = (deviations.astype(object) ** 2).sum(1)
    return [int(v) if v < LONG else None for v in exact]


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), size)


def _usable(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.forall(
        F.col(vector), lambda e: F.coalesce(F.abs(e.cast("double")) < LARGEST / SCALE, F.lit(False)))


class Whitening:
    """Statistics of a list of vectors: ``n``, ``sums``, ``values``, ``components``, ``trace`` and ``identity_error``.

    ``rows`` holds the vectors as arrays of doubles in the column ``vector``,
    all usable and of ``size`` entries.
    """

    def __init__(self, rows: DataFrame, vector: str, size: int, n: int, sums: list[int], wanted: int) -> None:
        self.n, self.sums, self.size = n, sums, size
        scatter, total = self._products(rows.select(vector), self.centred, size)
        self.trace = float(np.trace(scatter)) / n
        values, components = one_sided_jacobi(pivoted_cholesky(scatter / n))
        self.values, self.components = values[:wanted], components[:, :wanted]
        self.projection = self.components / np.sqrt(self.values)
        self.identity_error = 0.0
        if len(self.values):
            project, mean = self.projection, total / n @ self.projection
            centred = self.centred
            found, _ = self._products(rows.select(vector), lambda x: centred(x) @ project - mean, len(self.values))
            self.identity_error = float(np.abs(found / n - np.eye(len(found))).max())

    @property
    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        n, sums = self.n, self.sums
        return lambda x: exact_deviations(x, n, sums).astype(np.float64) / n

    def _products(self, rows: DataFrame, measure: Callable, out: int) -> tuple[np.ndarray, np.ndarray]:
        """(sum of products of every two columns, sum of every column) of ``measure`` over all rows.

        A task sends one row per column, so ``out`` of them, and Spark adds them up.
        """
        size = self.size

        def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            products, total, seen = np.zeros((out, out)), np.zeros(out), False
            for batch in batches:
                if batch.num_rows:
                    seen = True
                    values = measure(_whole(_matrix(batch.column(0), size)))
                    products += values.T @ values
                    total += values.sum(0)
            if seen:
                lines = [*(products[i, i:] for i in range(out)), total]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(out + 1), pa.int32()), pa.array(lines, pa.list_(pa.float64()))], ["line", "numbers"])

        parts = rows.mapInArrow(reduce, "line int, numbers array<double>")
        summed = parts.select("line", F.posexplode("numbers").alias("at", "v")).groupBy("line", "at").agg(F.sum("v").alias("v"))
        products, total = np.zeros((out, out)), np.zeros(out)
        for line, at, v in summed.collect():
            if line == out:
                total[at] = v
            else:
                products[line, line + at] = products[line + at, line] = v
        return products, total


def _count(rows: DataFrame, vector: str) -> tuple[int, int, list[int]]:
    """(size, n, sums) of the vectors of the commonest size, the longer of equally common ones."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in batches:
            vectors = batch.column(0)
            lengths = np.diff(np.asarray(vectors.offsets))
            for size in np.unique(lengths).tolist():
                chosen = vectors.filter(pa.array(lengths == size))
                high = _whole(_matrix(chosen, size))
                # Halves of 32 bits cannot overflow when added up.
                low = (high & 0xFFFFFFFF).sum(0).tolist()
                high = (high >> 32).sum(0).tolist()
                counts[size] = counts.get(size, 0) + len(chosen)
                sums[size] = [s + (h << 32) + l for s, h, l in zip(sums.get(size, [0] * size), high, low)]
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64()),
                 pa.array([[Decimal(v) for v in sums[s]] for s in counts], pa.list_(pa.decimal128(38, 0)))], ["size", "n", "sums"])

    parts = cut_lineage(rows.select(vector).mapInArrow(reduce, "size int, n long, sums array<decimal(38,0)>"))
    best = parts.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return 0, 0, []
    summed = (parts.where(F.col("size") == best.size).select(F.posexplode("sums").alias("at", "v"))
              .groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect())
    return best["size"], best["n"], [int(r.v) for r in summed]


def whiten(df: DataFrame, vector: str = "embedding", into: str = "whitening", components: int = COMPONENTS) -> DataFrame:
    """The usable rows of ``df`` with a struct ``into``: n, deviation, whitened, explained, identity_error.

    An entry c counts as the whole number x = floor(64 c) + 1000000.  ``whitened``
    and ``explained`` are arrays over the first ``components`` eigenvectors of
    the covariance of x (divisor n), by falling eigenvalue: projections of the
    centred x at unit variance, and shares of the total variance.  Fewer come
    out where the vectors span fewer dimensions; a single vector or equal ones
    have none.  ``deviation`` is the sum of (n x - S) ** 2, null beyond a long.

    Rows go whose vector is null, holds a null or non-finite entry or one
    beyond 2 ** 56, is empty, or has another length than most (the longer of
    equally common lengths stays).  Repeated rows count each; an empty table
    gives an empty one; a column named as ``into`` is replaced.
    """
    ship(df.sparkSession)
    values = "__vector"
    usable = df.where(_usable(vector)).withColumn(values, F.col(vector).cast("array<double>"))
    size, n, sums = _count(usable, values)
    usable = usable.where((F.size(values) == size) & (F.size(values) > 0))
    if not size:
        return usable.drop(values).withColumn(into, F.lit(None).cast(
            "struct<n: long, deviation: long, whitened: array<double>, explained: array<double>, identity_error: double>"))
    fit = Whitening(usable, values, size, n, sums, components)
    project, centred = fit.projection, fit.centred

    @F.pandas_udf(FIELDS)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            x = _whole(np.stack(vectors.to_numpy())) if len(vectors) else np.zeros((0, size), np.int64)
            yield pd.DataFrame({"deviation": pd.array(squared_length(exact_deviations(x, n, sums)), "Int64"),
                                "whitened": list(centred(x) @ project)})

    measured = usable.withColumn("__m", measure.asNondeterministic()(values))
    explained = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values]).cast("array<double>")
    return measured.withColumn(into, F.struct(
        F.lit(n).cast("long").alias("n"), F.col("__m.deviation").alias("deviation"), F.col("__m.whitened").alias("whitened"),
        explained.alias("explained"), F.lit(fit.identity_error).alias("identity_error"))).drop(values, "__m")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    each = whiten(vectors, into="w").select(
        "vec_id", "w.n", "w.deviation", "w.identity_error", F.col("w.explained").alias("shares"), F.posexplode("w.whitened"))
    return each.select("vec_id", (F.col("pos") + 1).cast("int").alias("component"), "n", "deviation",
                       F.col("col").alias("whitened"), F.get("shares", F.col("pos")).alias("explained"), "identity_error")


QUERIES = {"op11_embedding_whitening": op11_embedding_whitening}
ORACLES: dict[str, str] = {}
