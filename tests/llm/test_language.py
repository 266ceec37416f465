"""Language identification: held-out accuracy, calibration and the parts of the model."""

import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SAMPLE
from pyspark.sql import functions as F

from ledgerloom.llm import language


@pytest.fixture(scope="module")
def predicted(spark):
    folder = SAMPLE.replace("0.001", "0.01")
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    return language.op12_language_id(spark, folder).join(truth, "doc_id").toPandas()


def test_held_out_accuracy(predicted):
    assert len(predicted) == 1000
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(predicted.doc_id, predicted.held_out))
    unseen = predicted[predicted.held_out & predicted.lang.notna() & (predicted.lang_pred != "und")]
    assert len(unseen) > 200 and (unseen.lang == unseen.lang_pred).mean() >= 0.99
    assert predicted.score.between(0, 1).all() and set(predicted.lang_pred) <= set(predicted.lang.dropna()) | {"und"}
    sure = abs(unseen.score.mean() - (unseen.lang == unseen.lang_pred).mean())
    assert sure < 0.02  # calibrated: as sure as it is right


def test_letters_and_buckets():
    text = "Ça\t va?  ЁЖ-7 é!"
    points = language.letters_of(text)
    assert "".join(map(chr, points)) == " ça va ёж é "
    grams = [tuple(points[i:i + n]) for n in range(1, 4) for i in range(len(points) - n + 1)]
    (buckets,) = language.buckets_of(points)
    by_gram = {}
    for gram, bucket in zip(grams, buckets.tolist()):
        assert by_gram.setdefault(gram, bucket) == bucket
    found, counts = language.counts_of(points)
    assert dict(zip(found.tolist(), counts.tolist())) == Counter(buckets.tolist())
    assert set(language._Distinct().of(points).tolist()) == set(found.tolist())
    assert len(language.letters_of("12 ́ ...")) == 0


def test_parts_of_a_long_text_miss_no_gram(monkeypatch):
    points = language.letters_of("the quick brown fox " * 40)
    whole = Counter(np.concatenate(list(language.buckets_of(points))).tolist())
    monkeypatch.setattr(language, "CHUNK", 17)
    assert Counter(np.concatenate(list(language.buckets_of(points))).tolist()) == whole
    assert dict(zip(*(a.tolist() for a in language.counts_of(points)))) == whole
    assert sorted(language._Distinct().of(points).tolist()) == sorted(whole)


def test_document_frequencies_cover_every_row(spark):
    texts = ["ab ab", "ab", "b", "", None, "77", "ab c"] * 5
    n, frequency = language.document_frequencies(spark.createDataFrame([(t,) for t in texts], "t string").repartition(4), "t")
    plain = Counter(b for t in texts if t for b in set(language.counts_of(language.letters_of(t))[0].tolist()))
    assert n == 20 and {i: int(frequency[i]) for i in np.flatnonzero(frequency)} == plain


def test_ftrl_by_the_published_rule():
    """One coordinate at a time, against the update of the algorithm written out."""
    rng = np.random.default_rng(0)
    model = language.Ftrl(5, 3)
    z, n = np.zeros((5, 3)), np.zeros((5, 3))
    for _ in range(60):
        at = np.sort(rng.choice(5, 3, replace=False))
        x, label = rng.random(3) * 0.05, int(rng.integers(3))
        w = np.array([[0.0 if abs(z[i, k]) <= language.L1 else -(z[i, k] - np.sign(z[i, k]) * language.L1)
                       / ((language.BETA + np.sqrt(n[i, k])) / language.ALPHA + language.L2) for k in range(3)] for i in at])
        e = np.exp(x @ w)
        p = e / e.sum()
        for a, i in enumerate(at):
            for k in range(3):
                g = x[a] * (p[k] - (k == label))
                sigma = (np.sqrt(n[i, k] + g * g) - np.sqrt(n[i, k])) / language.ALPHA
                z[i, k] += g - sigma * w[a, k]
                n[i, k] += g * g
        model.learn(at, x, label)
    assert np.allclose(model.z, z) and np.allclose(model.root ** 2, n)
    faint = language.Ftrl(1, 2)
    faint.learn(np.array([0]), np.array([language.L1 / 2]), 0)
    assert not faint.weights().any()  # below the first penalty a weight stays out


def test_temperature_is_the_best_divisor():
    rng = np.random.default_rng(1)
    true = rng.normal(size=(4000, 3)) * 2
    labels = np.array([rng.choice(3, p=p) for p in language.softmax(true)])
    assert language.temperature(true * 5, labels) == pytest.approx(5, rel=0.1)
    assert language.temperature(np.zeros((0, 3)), labels[:0]) == 1.0
    assert language.temperature(np.eye(3) * 9, np.arange(3)) >= language.COLDEST


def test_odd_texts_and_tables(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", "en"), (4, "the and with " * 9, "en"), (4, "the and with " * 9, "en"),
            (5, "le la les des " * 9, "fr"), (None, "der die das", None), (6, "the " * 300_000, "en"), (7, "日本語", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {"language": F.lit("mine"), "score": F.lit(1), "hash": F.lit("x"), "place": F.lit(0)})
    model = language.fit(docs)
    assert model.languages == ["en", "fr"]
    got = language.predict_language(docs, model).select("doc_id", "language.lang", "language.score").collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang, by[i].score) == ("und", 0.0) for i in (1, 2, 3))
    assert by[4].lang == by[6].lang == "en" and by[5].lang == "fr" and by[7].lang in ("en", "fr")
    assert len({(r.lang, r.score) for r in got if r.doc_id == 4}) == 1
    assert language.predict_language(docs.where("false"), model).count() == 0
    nothing = language.fit(docs.where("false"))
    assert {tuple(r) for r in language.predict_language(docs, nothing).select("language.*").collect()} == {("und", 0.0)}
    alone = language.fit(docs.where("lang = 'fr'"))
    assert language.predict_language(docs, alone).where("doc_id = 4").first().language.lang == "fr"


def test_copies_of_a_text_do_not_crowd_the_sample(spark):
    rows = [(i, "same words here", "en") for i in range(3000)] + [(3000 + i, f"{chr(97 + i % 26) * 3} other {i}", "en") for i in range(1500)]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("hash", F.xxhash64("doc_id", "text"))
    drawn = language._sample(known, 300, {"en": 4500}).toPandas()
    assert len(drawn) == 300 and 150 < (drawn.text == "same words here").sum() < 250
