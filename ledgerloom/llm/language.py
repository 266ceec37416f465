"""Language identification by sparse logistic regression on character n-grams.

Letters are lowered, everything between them is one space, and n-grams of one
to three characters fall into hashed buckets.  Document frequencies are counted
over all documents to learn from; the weights are learnt on a bounded sample by
follow-the-regularised-leader with an elastic net, and a temperature found on
rows that a model has not seen makes the scores probabilities.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table

ORDERS = 3
BITS = 18
BUCKETS = 1 << BITS
#: Code points that are hashed at a time, so that the longest text needs no more memory than that.
CHUNK = 1 << 18
#: Documents to learn the weights from, shared out evenly over the languages, and the least of a language.
SAMPLE = 1_600
LEAST = 20
EPOCHS = 2
FOLDS = 3
#: Step size, its offset, and the two penalties of the elastic net.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.002, 0.01
#: Bounds of the temperature: without errors among few rows the best one would be 0.
COLDEST, HOTTEST = 0.05, 20.0
UNKNOWN = "und"
SPACE = ord(" ")
_SALT = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


# --- features

@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: what it becomes (lower case; a space for all but letters and the marks on them), and whether it is a letter."""
    every = [chr(i) for i in range(sys.maxunicode + 1)]
    letter = np.fromiter((c.isalpha() for c in every), bool, len(every))
    mark = np.fromiter((unicodedata.category(c)[0] == "M" for c in every), bool, len(every))
    lower = np.fromiter((ord(c.lower()[0]) for c in every), np.uint32, len(every))
    return np.where(letter | mark, lower, np.uint32(SPACE)), letter


def letters_of(text: str) -> np.ndarray:
    """Code points of the words in lower case, each between single spaces; none without a letter."""
    becomes, letter = _characters()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not letter[points].any():
        return np.zeros(0, np.uint32)
    points = np.concatenate([[np.uint32(SPACE)], becomes[points], [np.uint32(SPACE)]])
    blank = points == SPACE
    blank[1:] &= blank[:-1].copy()
    blank[0] = False
    return points[~blank]


def buckets_of(points: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of all n-grams, in parts of at most ``ORDERS`` times ``CHUNK``."""
    for start in range(0, len(points), CHUNK):
        part = points[start:start + CHUNK + ORDERS - 1]
        own = min(CHUNK, len(points) - start)
        hashed = np.zeros(len(part), np.uint32)
        out = []
        for n in range(ORDERS):
            # The hash of the n-gram that starts at each place, from the one shorter by a character.
            hashed = hashed[:len(part) - n] * np.uint32(16777619) + part[n:]
            mixed = (hashed[:own] ^ (hashed[:own] >> np.uint32(15))) * _SALT[n]
            out.append(mixed >> np.uint32(32 - BITS))
        yield np.concatenate(out).astype(np.int32)


def counts_of(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, how often) of a text."""
    total: tuple[np.ndarray, np.ndarray] = np.zeros(0, np.int32), np.zeros(0, np.int64)
    for part in buckets_of(letters):
        buckets, counts = np.unique(np.concatenate([total[0], part]), return_inverse=True)
        weights = np.concatenate([total[1], np.ones(len(part), np.int64)])
        total = buckets, np.bincount(counts, weights, len(buckets)).astype(np.int64)
    return total


class _Distinct:
    """Tells the distinct buckets of a text without sorting: the last writer of a bucket stands for it."""

    def __init__(self) -> None:
        self.writer = np.zeros(BUCKETS, np.int32)

    def of(self, letters: np.ndarray) -> np.ndarray:
        parts = []
        for buckets in buckets_of(letters):
            place = np.arange(len(buckets), dtype=np.int32)
            self.writer[buckets] = place
            parts.append(buckets[self.writer[buckets] == place])
        return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts or [np.zeros(0, np.int32)]))


def document_frequencies(texts: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """(documents with a letter, of these those with each bucket) over all rows; a task sends a row per bucket it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct, found, n = _Distinct(), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                letters = letters_of(value or "")
                if len(letters):
                    n += 1
                    found[distinct.of(letters)] += 1
        met = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(met, -1).astype(np.int32)), pa.array(np.append(found[met], n))], ["bucket", "n"])

    total = texts.select(text).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(BUCKETS, np.int64)
    known = total[total.bucket >= 0]
    frequency[known.bucket.to_numpy()] = known.n.to_numpy()
    return int(total[total.bucket < 0].n.sum()), frequency


# --- the model

class Ftrl:
    """Multinomial logistic regression by follow-the-regularised-leader, proximal, with an elastic net.

    A weight stays 0 until the gradients of its feature outweigh ``L1``.
    ``root`` is the square root of the summed squared gradients.
    """

    def __init__(self, features: int, classes: int) -> None:
        self.z = np.zeros((features, classes))
        self.root = np.zeros((features, classes))

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.root)

    @staticmethod
    def _weights(z: np.ndarray, root: np.ndarray) -> np.ndarray:
        return (np.clip(z, -L1, L1) - z) / ((BETA + root) / ALPHA + L2)

    def learn(self, features: np.ndarray, values: np.ndarray, label: int) -> None:
        z, root = self.z[features], self.root[features]
        w = self._weights(z, root)
        error = softmax(values @ w)
        error[label] -= 1
        g = np.outer(values, error)
        grown = np.sqrt(root * root + g * g)
        self.z[features] = z + g - (grown - root) / ALPHA * w
        self.root[features] = grown


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


Row = tuple[np.ndarray, np.ndarray, int]


def train(rows: list[Row], features: int, classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from (features, values, label) rows, in an order that only the seed decides."""
    model, rng = Ftrl(features, classes), np.random.default_rng(12)
    for _ in range(epochs):
        for at in rng.permutation(len(rows)):
            model.learn(*rows[at])
    return model.weights()


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest; 1 without rows."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high = np.log(COLDEST), np.log(HOTTEST)
    for _ in range(60):  # the loss has one valley over log T
        a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class Model:
    """What a scorer needs: languages, the rows of the weight table that are not 0, and the temperature.

    The table holds weight times inverse document frequency, so a text's logits
    are the mean of the table over its n-grams.
    """

    def __init__(self, rows: list[Row], languages: list[str], idf: np.ndarray) -> None:
        self.languages = languages
        k = len(languages)
        met = np.unique(np.concatenate([np.zeros(0, np.int32), *(buckets for buckets, *_ in rows)]))
        rows = [(np.searchsorted(met, buckets), values, label) for buckets, values, label in rows]
        logits, labels = np.zeros((0, k)), np.zeros(0, np.int64)
        for fold in range(FOLDS):  # each row meets weights that have not seen it
            unseen = rows[fold::FOLDS]
            if unseen and len(unseen) < len(rows):
                w = train([r for i, r in enumerate(rows) if i % FOLDS != fold], len(met), k)
                logits = np.concatenate([logits, [values @ w[features] for features, values, _ in unseen]])
                labels = np.concatenate([labels, [label for *_, label in unseen]])
        self.temperature = temperature(logits, labels)
        weights = train(rows, len(met), k) * idf[met, None]
        used = weights.any(axis=1)
        self.place = np.zeros(BUCKETS, np.int32)  # 0 is the row of the buckets without weight
        self.place[met[used]] = np.arange(1, used.sum() + 1)
        self.table = np.concatenate([np.zeros((1, k)), weights[used]])

    def predict(self, text: str) -> tuple[str, float]:
        letters = letters_of(text)
        if not len(letters) or not self.languages:
            return UNKNOWN, 0.0
        total, seen = np.zeros(len(self.languages)), 0
        for buckets in buckets_of(letters):
            total += np.ones(len(buckets)) @ np.take(self.table, np.take(self.place, buckets), axis=0)
            seen += len(buckets)
        p = softmax(total / seen / self.temperature)
        best = int(p.argmax())  # of equally likely ones the first by name
        return self.languages[best], float(p[best])


def _sample(known: DataFrame, per_language: int, counts: dict[str, int]) -> DataFrame:
    """At most ``per_language`` rows of each language, by a hash; few more than these are shuffled."""
    draw = F.pmod("hash", F.lit(1 << 30)).cast("double") / float(1 << 30)
    shares = F.create_map(*[x for name, n in counts.items() for x in (F.lit(name), F.lit(min(1.0, (2.0 * per_language + 10.0) / n)))])
    drawn = known.withColumn("draw", draw).where(F.col("draw") < F.element_at(shares, F.col("lang")))
    ranked = drawn.selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY hash, text) AS place")
    return ranked.where(F.col("place") <= per_language)


def fit(train_rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """A model from the rows of known language; texts without a letter teach nothing.

    Document frequencies cover all rows.  The weights come from ``sample`` rows
    at most, shared out evenly over the languages, but ``LEAST`` of each; a hash
    of ``key`` and text draws them, so that copies under keys of their own are
    drawn each by itself.
    """
    ship(train_rows.sparkSession)
    known = train_rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(key, text).alias("hash")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], [], np.ones(BUCKETS))
    n, frequency = document_frequencies(known, "text")
    idf = np.log((1 + n) / (1 + frequency)) + 1

    @F.pandas_udf("buckets array<int>, counts array<long>")
    def counted(texts: pd.Series) -> pd.DataFrame:
        found = [counts_of(letters_of(t)) for t in texts]
        return pd.DataFrame({"buckets": [b for b, _ in found], "counts": [c for _, c in found]})

    chosen = _sample(known, max(LEAST, sample // len(languages)), counts)
    collected = chosen.select("lang", "place", counted("text").alias("f")).orderBy("place", "lang").select("lang", "f.*").toPandas()
    rows = []
    for name, buckets, found in zip(collected["lang"], collected["buckets"], collected["counts"]):
        if len(buckets):
            rows.append((np.asarray(buckets), np.asarray(found) / np.sum(found) * idf[buckets], languages.index(name)))
    return Model(rows, languages, idf)


def predict_language(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct ``into``: ``lang`` and ``score``.

    ``lang`` is a language the model has learnt, ``score`` its calibrated
    probability.  A null text or one without a letter is ``und`` with score 0,
    and so is every text under a model that has learnt nothing.  Equal texts
    have equal results; an empty table stays empty; a column named as ``into``
    is replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([sent.value.predict(t) for t in texts], columns=["lang", "score"])

    return docs.withColumn(into, predict.asNondeterministic()(F.coalesce(F.col(text), F.lit(""))))


# --- the query

def held_out(doc_id: Column) -> Column:
    """Rows that teach nothing: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(docs.where("NOT held_out"))
    found = predict_language(docs.select("doc_id", "text", "held_out"), model, into="found")
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


QUERIES = {"op12_language_id": op12_language_id}
ORACLES: dict[str, str] = {}
