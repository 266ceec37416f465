"""Training corpus from raw documents: quality, near-duplicates, secrets, mix, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  All but the last return the columns they were given.  Between stages the
rows are written out, so a lost executor costs a read and not the work before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import encode_corpus
from ledgerloom.llm.common import cut_lineage, with_place, write_in_order
from ledgerloom.llm.mixing import mix_sources
from ledgerloom.llm.quality import judge_quality
from ledgerloom.llm.secret_scan import redact, scan_secrets
from ledgerloom.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands of their script; null and empty texts go."""
    return judge_quality(docs, into="__quality").where("__quality.kept").drop("__quality")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash: the one of smallest id.

    Null and empty texts have the same fingerprint and are one group; of rows
    with the same id one stays; an empty table stays empty; columns of any name stay.
    """
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mask; ``n_chars`` follows where a text has changed.

    Null and empty texts stay as they are; repeated rows are masked each by
    itself; an empty table stays empty; columns of any name stay.
    """
    masked = redact(scan_secrets(docs, into="__secrets"), spans="__secrets")
    changed = F.size("__secrets") > 0
    return masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop("__secrets")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, spread over files by ranges of slots.

    A null source counts as the empty one; null and repeated ids are placed like
    others; an empty table stays empty; columns of any name stay.
    """
    return mix_sources(docs, into="__mix").orderBy("__mix.mix_slot", "__mix.mix_place").drop("__mix")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256, mix_position) in no order of rows.

    ``ids`` are little-endian 32-bit, the digest is of what they decode to, and
    ``mix_position`` is the row's place from 0 in the mix.
    """
    placed = with_place(docs.select("doc_id", "text"), "mix_position")
    keyed = placed.select(F.struct("doc_id", "mix_position").alias("key"), "text")
    encoded = encode_corpus(keyed, key="key", decode=True)
    return encoded.select("key.doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"), "key.mix_position")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", tokens),
]

#: Tokenizers, SimHash links and the schedule are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = write_in_order(docs) if stage is mix else cut_lineage(docs)
    return docs
