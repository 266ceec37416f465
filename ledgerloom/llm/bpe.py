"""Byte-level BPE over a corpus: distinct words are shuffled and encoded once each.

1. Every task splits its texts into pre-tokens.  A run of rows (a chunk) becomes
   one row per document, its pre-tokens as positions in the chunk's own list of
   distinct words, and that list.
2. The lists are dealt out by hash of the word, so each distinct word of the
   corpus meets one task and is encoded there once.  A chunk sends a word at
   most once: the commonest word of the corpus travels as often as there are
   chunks, so no word can outweigh the others.
3. Ids go back by chunk, where the positions put the documents together.

Positions and words travel packed, so what is shuffled stays below the text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from . import vocab
from .common import Numbering, partitions, ship, table

#: Characters after which a task closes a chunk; a longer document is a chunk of its own.
CHUNK_CHARS = 5_000_000
_PACKED = "chunk long, row int, words binary, positions binary, count int, {key}"


def _pack(numbers: np.ndarray) -> bytes:
    """Small numbers as compressed byte planes."""
    planes = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(packed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed, max_output_size=4 * count), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[starts[i]:starts[i] + lengths[i]]`` of all i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def _decode(ids: bytes, tokens: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    flat, starts, lengths = tokens
    numbers = np.frombuffer(ids, "<u4")
    return _gather(flat, starts[numbers], lengths[numbers]).tobytes()


def split_chunks(key: pa.Field, chunk_chars: int, pattern: str):
    """Arrow function from (part, key, text) rows to the packed rows of their chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern)
        schema = pa.schema([("chunk", pa.int64()), ("row", pa.int32()), ("words", pa.binary()),
                            ("positions", pa.binary()), ("count", pa.int32()), key])
        part, serial = 0, 0
        keys: list = []
        sequences: list[np.ndarray] = []
        number = Numbering()
        chars = 0

        def close() -> pa.RecordBatch:
            every = np.concatenate(sequences) if sequences else np.zeros(0, np.int64)
            uses = np.bincount(every, minlength=len(number))
            order = np.argsort(-uses, kind="stable")  # common words get small numbers
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            listed = list(number)
            raw = [listed[i].encode("utf-8", "replace") for i in order]
            words = _pack_strings(raw)
            chunk = (part << 32) | serial
            n = len(keys)
            return pa.RecordBatch.from_arrays([
                pa.array([chunk] * (n + 1), pa.int64()), pa.array(range(-1, n), pa.int32()),
                pa.array([words] + [None] * n, pa.binary()),
                pa.array([None] + [_pack(place[s]) for s in sequences], pa.binary()),
                pa.array([len(raw)] + [len(s) for s in sequences], pa.int32()),
                pa.array([None, *keys], key.type)], schema=schema)

        for batch in batches:
            for row in zip(*batch.columns, strict=True):  # one text at a time becomes an object
                part, own, text = (x.as_py() for x in row)
                if len(text) < chunk_chars:
                    found = find.findall(text)
                    sequences.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                else:  # never all pre-tokens of a huge text at once
                    sequences.append(np.fromiter((number[m.group()] for m in find.finditer(text)), np.int32))
                keys.append(own)
                chars += len(text)
                if chars >= chunk_chars:
                    yield close()
                    serial += 1
                    keys, sequences, number, chars = [], [], Numbering(), 0
        if keys:
            yield close()
    return run


def _pack_strings(strings: list[bytes], level: int = 3) -> bytes:
    """Byte strings as one compressed block, lengths first."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    body = len(sizes).to_bytes(4, "little") + sizes.astype("<u4").tobytes() + b"".join(strings)
    return zstandard.ZstdCompressor(level=level).compress(body)


def _unpack_strings(packed: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4).astype(np.int64))).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends, strict=False)]


def _buckets(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets


def list_words(buckets: int):
    """Arrow function from packed chunks to (chunk, bucket, words): the words of a chunk that fall in one bucket.

    A word's bucket is a hash of the word, so equal words of all chunks meet.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if packed is None:
                    continue
                words = _unpack_strings(packed)
                of = _buckets(words, buckets)
                order = np.argsort(of, kind="stable")
                cuts = np.searchsorted(of[order], np.arange(buckets + 1))
                own = [[words[i] for i in order[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                full = [b for b in range(buckets) if own[b]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(full), pa.int64()), pa.array(full, pa.int32()),
                     pa.array([_pack_strings(own[b]) for b in full], pa.binary())], names=["chunk", "bucket", "words"])
    return run


def encode_words(ranks):
    """Arrow function over (chunk, bucket, words) rows in bucket order: ids of the words, each distinct word encoded once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocab.byte_bpe(ranks.value).encode_ordinary

        class Known(dict):
            def __missing__(self, word: bytes) -> bytes:
                ids = self[word] = np.array(encode(word.decode()), "<u4").tobytes()
                return ids

        last, known = None, Known()
        for batch in batches:
            out = []
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if bucket != last:
                    last, known = bucket, Known()
                ids = list(map(known.__getitem__, _unpack_strings(packed)))
                counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                flat = np.frombuffer(b"".join(ids), "<u4")
                out.append(len(ids).to_bytes(4, "little") + len(flat).to_bytes(4, "little")
                           + _pack(np.concatenate([counts.astype("<u4"), flat])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("bucket"), pa.array(out, pa.binary())], names=["chunk", "bucket", "ids"])
    return run


def assemble(key: pa.Field, buckets: int, ranks=None):
    """Cogrouped function: the documents of one chunk and the ids of its words, put together by position.

    With ``ranks`` the ids are decoded by the token-byte table at once, which
    saves a second Python worker beside the one that has put them together.
    """
    schema = pa.schema([key, ("n_tokens", pa.int64()), ("ids", pa.binary()), *([("decoded", pa.binary())] if ranks else [])])

    def run(documents: pa.Table, words: pa.Table) -> pa.Table:
        if not documents.num_rows:
            return schema.empty_table()
        listed = next((w for w in documents.column("words").to_pylist() if w is not None))
        of = _buckets(_unpack_strings(listed), buckets)
        order = np.argsort(of, kind="stable")  # numbers in the order of their buckets
        counts, flat = [], []
        for _, packed in sorted(zip(words.column("bucket").to_pylist(), words.column("ids").to_pylist(), strict=True)):
            n, total = int.from_bytes(packed[:4], "little"), int.from_bytes(packed[4:8], "little")
            both = _unpack(packed[8:], n + total)
            counts.append(both[:n])
            flat.append(both[n:])
        flat = np.concatenate([*flat, np.zeros(0, "<u4")])
        sizes = np.concatenate([*counts, np.zeros(0, "<u4")]).astype(np.int64)
        lengths, starts = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        lengths[order], starts[order] = sizes, np.cumsum(sizes) - sizes
        keys, out, sizes, back = [], [], [], []
        for row, own, packed, count in zip(*(documents.column(c).to_pylist() for c in ("row", key.name, "positions", "count")), strict=True):
            if row < 0:
                continue
            positions = _unpack(packed, count).astype(np.int64) if count else np.zeros(0, np.int64)
            tokens = _gather(flat, starts[positions], lengths[positions])
            keys.append(own)
            out.append(tokens.tobytes())
            sizes.append(len(tokens))
            if ranks:
                back.append(_decode(out[-1], vocab.token_bytes(ranks.value)))
        columns = [pa.array(keys, key.type), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())]
        return pa.table([*columns, *([pa.array(back, pa.binary())] if ranks else [])], schema=schema)
    return run


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = vocab.BYTE_BPE,
                  pattern: str = vocab.PATTERN, chunk_chars: int = CHUNK_CHARS, decode: bool = False) -> DataFrame:
    """(key, n_tokens, ids) per row; ``ids`` are little-endian unsigned 32-bit numbers.

    With ``decode`` a column ``decoded`` has the bytes the ids stand for.

    Each match of ``pattern`` is encoded by the ranks of ``vocabulary``,
    without special tokens.  A null text counts as empty and has no ids.  Rows
    with equal or null keys are encoded each by itself; an empty table gives
    none.  ``key`` may be of any type Arrow knows; other columns are not read.
    ``docs`` must return its rows in the same order when a task is repeated, as
    a table does; cut the lineage of anything else first.
    """
    spark = docs.sparkSession
    ship(spark)
    ranks = vocab.send(spark, vocabulary)
    kind = docs.select(key).schema[0]
    # By its text, so that the fields of a struct may be null, as those of the word rows are.
    field = pa.field(key, to_arrow_type(StructType.fromDDL(f"`{key}` {kind.dataType.simpleString()}")[0].dataType))
    packed_type = _PACKED.format(key=f"`{key}` {kind.dataType.simpleString()}")
    n = partitions(spark)
    parts = docs.select(F.spark_partition_id().cast("long").alias("__part"), F.col(key),
                        F.coalesce(F.col(text), F.lit("")).alias("__text"))
    packed = parts.mapInArrow(split_chunks(field, chunk_chars, pattern), packed_type).repartition(n, "chunk")
    # Both uses read the same exchange, so texts are split once.
    buckets = 4 * n
    words = packed.mapInArrow(list_words(buckets), "chunk long, bucket int, words binary")
    ids = (words.repartition(n, "bucket").sortWithinPartitions("bucket")
           .mapInArrow(encode_words(ranks), "chunk long, bucket int, ids binary"))
    return packed.groupBy("chunk").cogroup(ids.repartition(n, "chunk").groupBy("chunk")).applyInArrow(
        assemble(field, buckets, ranks if decode else None),
        f"`{key}` {kind.dataType.simpleString()}, n_tokens long, ids binary" + ", decoded binary" * decode)


def decode_ids(ids: Column, spark: SparkSession, vocabulary: str = vocab.BYTE_BPE) -> Column:
    """Bytes of the ids by the token-byte table; the table has one row per rank, so every task holds it."""
    ship(spark)
    ranks = vocab.send(spark, vocabulary)

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = vocab.token_bytes(ranks.value)
        for packed in batches:
            yield pd.Series([_decode(x, tokens) for x in packed], dtype=object)
    return decoded(ids)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_corpus(table(spark, sf_dir, "documents"), decode=True)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op10_byte_bpe": op10_byte_bpe}
ORACLES: dict[str, str] = {}
