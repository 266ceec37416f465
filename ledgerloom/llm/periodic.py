"""Periodic runs of words: stretches that repeat with a smallest period.

Positions whose next words are equal form classes; going down from the longest
common prefix, classes unite like trees in Kruskal's algorithm.  A run of
period q has positions s and s + q that become neighbours in one class exactly
when the prefix they share is all of the run after its first q words, so each
run is found where two positions become neighbours at a distance of at most
that prefix.  A text is judged inside its own row; no row is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, Numbering, ship, table

#: A run has at least this many words, and at least this many periods.
MIN_WORDS = 6
MIN_PERIODS = 4
#: Positions are sorted together for texts of about this many words.
WORDS_AT_ONCE = 400_000
SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


# --- sorted suffixes

def sorted_suffixes(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group) of the positions that share ``least`` words (a power of two) or more with another.

    ``words`` are numbers; a window that holds a number found once shares with
    none, so texts are parted by numbers of their own.  ``order`` sorts by
    suffix, ``group`` tells positions that share the first ``least`` words.
    Each doubling sorts only the positions that are still tied.
    """
    n = len(words)
    rank = words.astype(np.int64)
    tied = np.arange(n)
    width, group = 0, None
    while len(tied):
        following = rank[tied + width] if width else np.zeros(len(tied), np.int64)
        order = np.lexsort((following, rank[tied]))
        at, second = tied[order], following[order]
        first = rank[at]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        # The number of a class is the place of its first position among all, so that classes keep their order.
        if width:
            opens = np.ones(len(at), bool)
            opens[1:] = first[1:] != first[:-1]
            inside = np.arange(len(at)) - np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
            places = first + inside
        else:
            places = np.arange(len(at))
        rank[at] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        last = np.append(fresh[1:], True)
        tied = at[~(fresh & last)]
        width = 2 * width if width else 1
        if width == least:
            group = (np.sort(tied), rank.copy())
    if group is None or not len(group[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kept, grouped = group
    order = kept[np.argsort(rank[kept], kind="stable")]
    return order, grouped[order]


def common_prefixes(words: list[int], order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Words that each position of ``order`` shares with the one before it; 0 at the start of a group.

    Positions are visited from left to right: a step to the right loses at
    most one shared word, so the work is linear.
    """
    before = np.full(len(order), -1)
    same = group[1:] == group[:-1]
    before[1:][same] = order[:-1][same]
    by_place = np.argsort(order)
    shared = np.zeros(len(order), np.int64)
    h, last = 0, -1
    for k, i, j in zip(by_place.tolist(), order[by_place].tolist(), before[by_place].tolist()):
        h = max(0, h - (i - last))
        last = i
        if j < 0:
            h = 0
            continue
        while words[i + h] == words[j + h]:
            h += 1
        shared[k] = h
    return shared


# --- classes

class Places:
    """An ordered set of positions in blocks, so that an insertion moves few of them."""

    BLOCK = 1024

    def __init__(self, place: int) -> None:
        self.blocks, self.size = [[place]], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def _find(self, place: int) -> tuple[int, int]:
        if len(self.blocks) == 1:
            return 0, bisect_left(self.blocks[0], place)
        at = min(bisect_left(self.blocks, place, key=lambda b: b[-1]), len(self.blocks) - 1)
        return at, bisect_left(self.blocks[at], place)

    def around(self, place: int) -> tuple[int, int]:
        """The neighbours on both sides of a place that is not in the set; -1 for none."""
        at, i = self._find(place)
        block = self.blocks[at]
        left = block[i - 1] if i else (self.blocks[at - 1][-1] if at else -1)
        right = block[i] if i < len(block) else (self.blocks[at + 1][0] if at + 1 < len(self.blocks) else -1)
        return left, right

    def add(self, place: int) -> None:
        at, i = self._find(place)
        block = self.blocks[at]
        block.insert(i, place)
        self.size += 1
        if len(block) > self.BLOCK:
            half = len(block) // 2
            self.blocks[at:at + 1] = [block[:half], block[half:]]


def new_neighbours(order: list[int], shared: list[int]) -> Iterator[tuple[int, int, int]]:
    """(i, j, words shared) of the positions i < j that become neighbours as classes unite from the longest prefix down.

    ``shared[k]`` belongs to ``order[k - 1]`` and ``order[k]``.  The smaller
    class moves into the larger one, so a position moves at most log n times.
    """
    parent = list(range(len(order)))
    sets: list[Places | None] = [None] * len(order)

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k in sorted((k for k in range(1, len(order)) if shared[k]), key=lambda k: -shared[k]):
        a, b = root(k - 1), root(k)
        large = sets[a] or Places(order[a])
        small = sets[b] or Places(order[b])
        if large.size < small.size:
            a, b, large, small = b, a, small, large
        gaps = [(place, *large.around(place)) for place in small]
        for at, (place, left, right) in enumerate(gaps):
            if left >= 0 and (at == 0 or gaps[at - 1][1] != left):
                yield left, place, shared[k]
            if right >= 0 and (at + 1 == len(gaps) or gaps[at + 1][2] != right):
                yield place, right, shared[k]
        for place, _, _ in gaps:
            large.add(place)
        parent[b], sets[a], sets[b] = a, large, None


# --- runs

def runs_of(numbers: list[np.ndarray], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start, then period; texts are word numbers from 0.

    ``min_periods`` is at least 2: below that a stretch does not repeat.
    """
    least = 1
    need = min(max(min_words - q, (min_periods - 1) * q) for q in range(1, max(2, min_words)))
    while 2 * least <= need:
        least *= 2
    sizes = np.array([len(w) for w in numbers])
    ends = np.cumsum(sizes + 1)  # a text ends at a number of its own
    starts = ends - sizes - 1
    found: list[list[tuple[int, int, int]]] = [[] for _ in numbers]
    texts = np.repeat(np.arange(len(numbers)), sizes + 1)
    words = np.zeros(len(texts), np.int64)
    for one, start, size in zip(numbers, starts, sizes):
        words[start:start + size] = one
    vocabulary = int(words.max(initial=0)) + 1
    words += texts * vocabulary
    words[ends - 1] = len(numbers) * vocabulary + np.arange(len(numbers))
    order, group = sorted_suffixes(words, least)
    if not len(order):
        return found
    flat = words.tolist()
    shared = common_prefixes(flat, order, group)
    for i, j, h in new_neighbours(order.tolist(), np.where(shared >= need, shared, 0).tolist()):
        q = j - i
        if h >= (min_periods - 1) * q and h + q >= min_words:
            text = texts[i]
            if i == starts[text] or flat[i - 1] != flat[j - 1]:  # it reaches no further to the left
                found[text].append((int(i - starts[text]), int(h + q), int(q)))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of runs and those of each run's first period, joined by one space.

    A word goes if any run holds it after that run's first period.
    """
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return b" ".join(w for w, k in zip(words, keep.tolist()) if k)


def find_in_texts(texts: list[str], min_words: int, min_periods: int) -> Iterator[tuple]:
    """The fields of ``SCHEMA`` for every text, texts of about ``WORDS_AT_ONCE`` words at a time."""
    group: list[list[bytes]] = []
    size = 0
    for at, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly 0x20 and 0x09-0x0D
        group.append(words)
        size += len(words)
        if size >= WORDS_AT_ONCE or at + 1 == len(texts):
            number = Numbering()
            numbers = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in group]
            for w, runs in zip(group, runs_of(numbers, min_words, min_periods), strict=True):
                yield (len(w), [dict(zip(("start", "length", "period"), r)) for r in runs],
                       collapse(w, runs).decode("utf-8", "surrogatepass"))
            group, size = [], 0


def periodic_runs(docs: DataFrame, text: str = "text", into: str = "periodic", min_words: int = MIN_WORDS,
                  min_periods: int = MIN_PERIODS) -> DataFrame:
    """``docs`` with a struct ``into``: ``n_words``, ``runs`` and ``collapsed``.

    Words are what ASCII white space parts.  ``runs`` lists (start, length,
    period), by start and then period, of every longest stretch with smallest
    period q of at least ``min_words`` words and ``min_periods`` (2 or more)
    periods; ``collapsed`` is the text without the repetitions, joined by single
    spaces.  A null or empty text has no words, no runs and collapses to an
    empty string.  Equal texts have equal results, each row its own; an empty
    table stays empty; a column named as ``into`` is replaced.
    """
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    ship(docs.sparkSession)

    @F.pandas_udf(SCHEMA)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(list(find_in_texts(list(texts), min_words, min_periods)), columns=["n_words", "runs", "collapsed"])

    # Called nondeterministic, it is worked out once a row in a step of its own, whatever is read from its fields.
    return docs.withColumn(into, find.asNondeterministic()(F.coalesce(F.col(text), F.lit(""))))


# --- the query

def looped(doc_id: Column, text: Column) -> Column:
    """The text, in every tenth document (by crc32 of its id) with its end replaced by one stretch over and over.

    Words from a on become word a + (i - a) % p of the text; a null id loops nothing.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    n = F.size(words).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")

    head, stretch = F.slice(words, 1, a.cast("int")), F.slice(words, (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(stretch, F.ceil((n - a) / p).cast("int")))
    whole = F.array_join(F.concat(head, F.slice(again, 1, (n - a).cast("int"))), " ")
    return F.when((h % 10 == 0) & text.rlike(WORD), whole).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs, into="p").select("doc_id", "p.runs", "p.collapsed")
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(F.try_divide(1000 * F.col("best.length"), -F.col("best.period"))).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: Texts of up to 4 * 2 ** LEVELS words; a window of 2 ** k words tells the periods from 2 ** (k - 1) + 1 to 2 ** k.
LEVELS = 22


def _sql() -> str:
    """Runs by windows: the next place of a window as long as the period, or up to twice that, is one period away.

    Neighbouring places with the same distance make up one run.  Windows of
    2 ** k words are told apart by hashes of hashes.
    """
    white = r"[^\x20\x09-\x0D]+"
    steps = ["""h0 AS (SELECT doc_id, i, hash(w) AS h FROM words)"""]
    for k in range(1, LEVELS + 1):
        steps.append(f"""h{k} AS (SELECT a.doc_id, a.i, hash(a.h, b.h) AS h FROM h{k - 1} a JOIN h{k - 1} b
            ON a.doc_id = b.doc_id AND b.i = a.i + {1 << (k - 1)})""")
    far = []
    for k in range(LEVELS + 1):
        m = 1 << k
        far.append(f"""SELECT doc_id, i, d, {m} AS m FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS d
            FROM h{k}) WHERE d <= {m} AND d > {m // 2}""")
    return f"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[],
            lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
        hashed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{white}') AS ws,
            xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(cast(doc_id AS varchar), ''),
                lambda c: ascii(c)::BIGINT)), lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1])), 4294967295) AS h
            FROM documents, crc),
        sized AS (SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS loops, h // 10 AS g FROM hashed),
        placed AS (SELECT *, CASE WHEN loops THEN g % n END AS a FROM sized),
        param AS (SELECT *, CASE WHEN loops THEN 1 + (n - a) // (3 + g % 8) END AS p FROM placed),
        words AS MATERIALIZED (SELECT doc_id, i, CASE WHEN loops AND i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS w
            FROM (SELECT *, unnest(range(n)) AS i FROM param)),
        {', '.join(steps)},
        near AS ({' UNION ALL '.join(far)}),
        isles AS (SELECT doc_id, d, m, i, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS isle FROM near),
        runs AS MATERIALIZED (SELECT doc_id, min(i) AS start, d AS period, count(*) - 1 + m + d AS length FROM isles
            GROUP BY doc_id, d, m, isle HAVING count(*) - 1 + m + d >= greatest({MIN_WORDS}, {MIN_PERIODS} * d)),
        dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
        kept AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS t FROM words w
            WHERE NOT EXISTS (SELECT 1 FROM dropped x WHERE x.doc_id = w.doc_id AND x.i = w.i) GROUP BY 1),
        digests AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), ''
            ORDER BY start, period) AS t FROM runs GROUP BY 1),
        best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS rn FROM runs)
            WHERE rn = 1)
        SELECT s.doc_id, coalesce(g.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length,
            b.period::BIGINT AS period, (1000 * b.length // b.period)::BIGINT AS exponent_milli,
            sha256(coalesce(g.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
        FROM sized s LEFT JOIN digests g USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)"""


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLES = {"op13_periodic_runs": _sql()}
