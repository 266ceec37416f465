"""SimHash near-duplicates found by a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, partitions, ship, table
from .graph import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Consecutive codes under one leaf, and nodes under one upper node.
LEAF, FAN = 16, 8
#: Buckets with more codes than this are dealt out once more by other bits.
MAX_BUCKET = 50_000


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles, repeats counted, as a signed integer; 0 without a word."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    width = min(shingle, len(words))
    total = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, total, 1 << 16):  # a long text is hashed piece by piece
        upto = min(total, at + (1 << 16))
        spans = zip(starts[at:upto].tolist(), (ends[at + width - 1:upto + width - 1] - 1).tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > total).tobytes()
    return int.from_bytes(bits, "big", signed=True)


def simhash_of(shingle: int):
    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(t, shingle) for t in texts], dtype="int64")
    return fingerprint


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes in Gray order under nodes that hold the bits their codes share.

    ``masks[l]`` tells which bits all codes below a node of level ``l`` share
    and ``patterns[l]`` their values; bits already shared higher up are left
    out, so a search adds the differences up on its way down.
    """

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        every, some, size = self.codes, self.codes, LEAF
        shared = []
        while True:
            cuts = np.arange(0, len(every), size)
            every = np.bitwise_and.reduceat(every, cuts)
            some = np.bitwise_or.reduceat(some, cuts)
            shared.append((~(every ^ some), every))
            size = FAN
            if len(cuts) <= FAN:
                break
        self.masks, self.patterns = [], []
        for level, (mask, pattern) in enumerate(shared):
            above = shared[level + 1][0][np.arange(len(mask)) // FAN] if level + 1 < len(shared) else np.uint64(0)
            self.masks.append(mask & ~above)
            self.patterns.append(pattern)
        self.rest = ~shared[0][0][np.arange(len(self.codes)) // LEAF]

    def search(self, queries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) places of all pairs that differ in at most ``bits`` bits."""
        top = len(self.masks) - 1
        width = len(self.masks[top])
        query = np.repeat(np.arange(len(queries)), width)
        node = np.tile(np.arange(width), len(queries))
        spent = np.zeros(len(node), np.uint8)
        for level in range(top, -1, -1):
            spent = spent + np.bitwise_count((queries[query] ^ self.patterns[level][node]) & self.masks[level][node])
            near = spent <= bits  # a node too far away takes all codes below it out
            query, node, spent = query[near], node[near], spent[near]
            query, node, spent = self._below(query, node, spent, FAN if level else LEAF,
                                             len(self.masks[level - 1]) if level else len(self.codes))
        spent = spent + np.bitwise_count((queries[query] ^ self.codes[node]) & self.rest[node])
        near = spent <= bits
        return query[near], node[near]

    @staticmethod
    def _below(query, node, spent, fan, count):
        child = (node[:, None] * fan + np.arange(fan)).ravel()
        there = child < count
        return np.repeat(query, fan)[there], child[there], np.repeat(spent, fan)[there]

    def groups(self, bits: int) -> np.ndarray:
        """For each code the place of the first code of its group of linked codes."""
        label = np.arange(len(self.codes))
        step = max(1, (1 << 21) // len(self.codes))
        for at in range(0, len(self.codes), step):
            found, other = self.search(self.codes[at:at + step], bits)
            _merge(label, found + at, other)
        return label


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of ``a`` and ``b``; labels point at the smallest member."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        high, low = np.maximum(la, lb)[differ], np.minimum(la, lb)[differ]
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def link_buckets(bits: int):
    """Arrow function over (bucket, code) rows in bucket order: links that connect all near codes of a bucket.

    A bucket of n codes gives at most n - 1 links, whatever its pairs.
    """
    def close(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        index = GrayIndex(codes)
        label = index.groups(bits)
        linked = label != np.arange(len(label))
        return index.codes[linked], index.codes[label[linked]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(links):
            a, b = (np.concatenate([x[i] for x in links]).view(np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        open_key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            codes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            links = []
            for i, (start, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if i == 0 and keys[0] != open_key or i > 0:
                    if sum(map(len, held)) > 1:
                        links.append(close(np.concatenate(held)))
                    open_key, held = keys[start], []
                held.append(codes[start:end])
            if links:
                yield batch_of(links)
        if sum(map(len, held)) > 1:
            yield batch_of([close(np.concatenate(held))])
    return run


def near_links(codes: DataFrame, bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) that connect all codes of ``codes.code`` (distinct) at most ``bits`` bits apart.

    Codes are dealt out by ``bits + 1`` blocks of their bits, of which two
    near codes share one at least.  The codes of a bucket that grows too large
    are dealt out again by blocks of the bits not yet used, so that no task
    holds a crowd; what no bits are left to split is searched as it is.
    """
    spark = codes.sparkSession
    ship(spark)
    width, blocks = 64, bits + 1
    todo = codes.select(F.lit(0).cast("long").alias("bucket"), "code", F.col("code").alias("rest"))
    links = None
    while True:
        cuts = [width * i // blocks for i in range(blocks + 1)]
        pieces = []
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            ones = (1 << (high - low)) - 1
            piece = F.shiftrightunsigned("rest", low).bitwiseAND(ones)
            above = F.shiftleft(F.shiftrightunsigned("rest", high), low) if high < 64 else F.lit(0).cast("long")
            pieces.append(F.struct(F.xxhash64("bucket", F.lit(low), piece).alias("bucket"),
                                   above.bitwiseOR(F.col("rest").bitwiseAND((1 << low) - 1)).alias("rest")))
        todo = cut_lineage(todo.select("code", F.explode(F.array(*pieces)).alias("p"))
                           .select("p.bucket", "code", "p.rest"))
        width -= min(b - a for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        sizes = todo.groupBy("bucket").count()
        crowded = sizes.where(F.col("count") > max_bucket).select("bucket")
        final = width < 2 * blocks or crowded.isEmpty()
        ready = todo if final else todo.join(crowded, "bucket", "left_anti")
        rows = ready.select("bucket", "code").repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "code")
        found = rows.mapInArrow(link_buckets(bits), "a long, b long")
        links = found if links is None else links.union(found)
        if final:
            return links
        todo = todo.join(crowded, "bucket", "left_semi")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, code, component_id) for every row of ``docs``.

    ``code`` is the SimHash of the whole text; codes at most ``bits`` bits
    apart are linked, and ``component_id`` is the smallest id reachable.  Equal
    codes are searched once.  A null text counts as empty; empty texts have
    code 0 and are linked like any other.  Rows without an id get the smallest
    id of their component, null if it has none.  Repeated rows stay repeated;
    an empty table gives none; other columns are not read.
    """
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    prints = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("text_hash"),
                                     simhash_of(shingle)(body).alias("code")))
    codes = cut_lineage(prints.groupBy("code").agg(F.min("doc_id").alias("least")))
    found = components(near_links(codes, bits)).withColumnRenamed("node", "code")
    grouped = codes.join(found, "code", "left").withColumn("component", F.coalesce("component", "code"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "component").select("code", "component_id", "component")
    return prints.join(named, "code")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the smallest id, then the smallest text hash."""
    groups = near_duplicates(docs, doc_id, text, shingle, bits)
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_hash").cast("string"))
    chosen = groups.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"))
    chosen = chosen.select(F.col("first.doc_id"), F.col("first.text_hash")).select(name.alias("__row"))
    own = F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
                      F.xxhash64(F.coalesce(F.col(text), F.lit(""))).cast("string"))
    return (docs.withColumn("__row", own).join(chosen, "__row", "left_semi")
            .dropDuplicates(["__row"]).drop("__row"))


def op6_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash_gray": op6_simhash_gray}
ORACLES: dict[str, str] = {}
