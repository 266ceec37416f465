"""Periodic runs against every period tried in turn."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from compare import oracle_connection
from conftest import SAMPLE
from pyspark.sql import functions as F

from ledgerloom.llm import periodic


def plain_runs(words, min_words=6, min_periods=4):
    out = []
    for q in range(1, len(words) + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            stretch = words[start:start + length]
            if i > start and length >= max(min_words, min_periods * q) and not any(
                    stretch[r:] == stretch[:-r] for r in range(1, q)):
                out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, letters = rng.randint(0, 60), rng.choice([1, 2, 3, 8])
    words = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.5:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize(("min_words", "min_periods"), [(6, 4), (2, 2), (4, 2), (1, 3), (6, 3)])
def test_runs_of_random_words(min_words, min_periods):
    rng = random.Random(min_words * 10 + min_periods)
    for _ in range(300):
        texts = [some_words(rng) for _ in range(rng.randint(1, 4))]
        got = periodic.runs_of([np.array(t, np.int64) for t in texts], min_words, min_periods)
        assert got == [plain_runs(t, min_words, min_periods) for t in texts]


def test_sets_in_blocks_keep_their_order():
    rng = random.Random(2)
    places = rng.sample(range(10**6), 5000)
    kept = periodic.Places(places[0])
    for i, place in enumerate(places[1:], 1):
        if i % 97 == 0:
            below = [p for p in places[:i] if p < place]
            above = [p for p in places[:i] if p > place]
            assert kept.around(place) == (max(below, default=-1), min(above, default=-1))
        kept.add(place)
    assert list(kept) == sorted(places) and len(kept.blocks) > 4


def test_long_repetitive_texts_take_no_quadratic_time():
    rng = random.Random(3)
    start = time.perf_counter()
    assert periodic.runs_of([np.zeros(100_000, np.int64)]) == [[(0, 100_000, 1)]]
    crowd = np.array([x for _ in range(30_000) for x in (0, 1, 2, 3, 4, 5 + rng.randrange(10**6))])
    assert periodic.runs_of([crowd]) == [[]]
    assert time.perf_counter() - start < 30


def test_runs_of_odd_texts(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "a b " * 20_000, "x"), (5, "a b c", "x"), (5, "a b c", "x"),
            (None, "z z z z z z", None), (6, "x " + "日本 語 " * 4 + "y", "x"), (7, "           ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumn("periodic", F.lit("mine"))
    got = {(r.doc_id, i): r for i, r in enumerate(periodic.periodic_runs(docs).orderBy("doc_id", "text").collect())}
    assert len(got) == len(rows)
    by = {k[0]: r.periodic for k, r in got.items()}
    assert all(by[i].n_words == 0 and by[i].runs == [] and by[i].collapsed == "" for i in (1, 2, 3))
    assert [tuple(r) for r in by[4].runs] == [(0, 40_000, 2)] and by[4].collapsed == "a b"
    assert by[5].runs == [] and by[5].collapsed == "a b c"
    assert by[None].collapsed == "z" and by[7].n_words == 6 and by[7].collapsed == " "
    assert [tuple(r) for r in by[6].runs] == [(1, 8, 2)] and by[6].collapsed == "x 日本 語 y"
    assert periodic.periodic_runs(docs.where("false")).count() == 0


def test_query_by_the_plain_rule(spark):
    """The query on the sample against Python, looped texts included."""
    duck = oracle_connection(SAMPLE)
    got = {r.doc_id: r for r in periodic.op13_periodic_runs(spark, SAMPLE).collect()}
    several = 0
    for doc_id, text in duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall():
        words = text.encode().split()
        if len(words) > 700:
            continue
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[doc_id]
        assert r.n_runs == len(runs) and (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
        several += bool(runs)
    assert several >= 5
