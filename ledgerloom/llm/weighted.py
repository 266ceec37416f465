"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its words and how often each occurs.  For sample k a
word draws r and c from Gamma(2, 1) and b from (0, 1), all from hashes of the
word and k.  With weight w,

    t = floor(ln w / r + b),   ln a = ln c - r * (t - b + 1)

and the word of smallest a is sample k, as the pair (word, t).  Two texts have
the same sample with a probability equal to their generalised Jaccard
similarity, the sum of the smaller weights over the sum of the larger.

Rows are dealt out once, by ranges of ids; words, weights, samples and the
neighbouring document are all found within that one partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, table

SAMPLES = 24
#: ASCII white space, made spaces before the split.
SPACES = "\t\n\x0b\x0c\r"
_LOW = (1 << 36) - 1


def _uniform(word: Column, salt: int) -> Column:
    """Number in (0, 1) from a word's hash."""
    return (F.shiftrightunsigned(F.xxhash64(word, F.lit(salt)), 12).cast("double") + 0.5) / float(1 << 52)


def _sample(word: Column, log_weight: Column, k: int) -> Column:
    """Sample k of one word as a long: ln a in the upper bits, a hash of (word, t) in the lower 36."""
    r = -F.log(_uniform(word, 5 * k) * _uniform(word, 5 * k + 1))
    log_c = F.log(-F.log(_uniform(word, 5 * k + 2) * _uniform(word, 5 * k + 3)))
    b = _uniform(word, 5 * k + 4)
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t.cast("double") - b + 1.0)
    return F.shiftleft(F.floor(log_a * float(1 << 18)), 36).bitwiseOR(
        F.xxhash64(word, t.cast("long")).bitwiseAND(_LOW))


def signature(samples: list[Column]) -> Column:
    """Eight hex digits a sample; empty for a text without a word."""
    digits = [F.lower(F.lpad(F.hex(s.bitwiseAND(0xFFFFFFFF)), 8, "0")) for s in samples]
    return F.when(samples[0].isNull(), F.lit("")).otherwise(F.concat(*digits))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples; 1 for two empty signatures and 0 for an empty and another."""
    same = sum((F.substring(a, 8 * k + 1, 8) == F.substring(b, 8 * k + 1, 8)).cast("int") for k in range(samples))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(same / float(samples))


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, place, doc_id, text, next_text, guest): every row with the text of the row of the next smaller id.

    After the smallest id comes the largest.  Rows without an id come last;
    equal ids go by hash of their text.  Buckets are ranges of ids whose
    bounds, one per bucket, come from quantiles.  The first row of the next
    bucket visits as a guest, so a whole text is moved once and no window
    spans more than a bucket.  Equal ids share a bucket.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_hash"))
    buckets = 4 * partitions(spark)
    bounds = base.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 20 * buckets)).first()[0]
    cuts = sorted(set(bounds or []), reverse=True)
    inside = (F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c >= F.col("doc_id"))) if cuts else F.lit(0))
    base = base.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(inside))
    first = base.groupBy("bucket").agg(F.min(F.struct(
        F.col("doc_id").isNull(), (-F.col("doc_id")).alias("down"), "text_hash")).alias("first"))
    # One row per bucket: as many as there are bounds, whatever the documents.
    heads = sorted((r["bucket"], r["first"]["down"], r["first"]["text_hash"]) for r in first.collect())
    visits = [(heads[i - 1][0], down, text_hash) for i, (_, down, text_hash) in enumerate(heads)]
    guests = spark.range(0).selectExpr("id AS down", "id AS head_hash", "CAST(id AS int) AS visits")
    if visits:
        guests = spark.range(1).select(F.explode(F.array(*[
            F.struct(F.lit(down).cast("long").alias("down"), F.lit(h).alias("head_hash"), F.lit(b).alias("visits"))
            for b, down, h in visits])).alias("g")).select("g.*")
    placed = base.join(F.broadcast(guests), (-F.col("doc_id")).eqNullSafe(F.col("down"))
                       & (F.col("text_hash") == F.col("head_hash")), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest"))
    placed = placed.select("doc_id", "text", "text_hash", F.explode(
        F.when(F.col("visits").isNull(), F.array(own)).otherwise(
            F.array(own, F.struct(F.col("visits").alias("bucket"), F.lit(1).alias("guest"))))).alias("at"))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), "text_hash")
    return placed.select("at.bucket", "at.guest", "doc_id", "text", "text_hash").select(
        "bucket", F.row_number().over(order).alias("place"), "doc_id", "text",
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text"), "guest")


def fingerprint_pairs(placed: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(bucket, place, doc_id, guest, n_chars, digest, fingerprint, edited_fingerprint) of rows of ``neighbours``."""
    take = F.floor(F.length("text") / 3).cast("int")
    rows = placed.withColumn("take", take).withColumn("head", F.substring(F.col("text"), F.lit(1), F.length("text") - F.col("take")))
    rows = rows.withColumn("edited", F.concat("head", F.substring(F.col("next_text"), F.lit(1), F.col("take"))))
    # What both texts begin with, up to the last word the cut leaves whole, is taken apart once.
    flat = [F.translate(c, SPACES, " " * len(SPACES)) for c in ("head", "text", "edited")]
    rows = rows.select("bucket", "place", "doc_id", "guest", F.length("text").cast("long").alias("n_chars"),
                       F.sha2("edited", 256).alias("sha"), *[c.alias(n) for c, n in zip(flat, ("head", "text", "edited"), strict=True)])
    whole = F.length("head") - F.length(F.substring_index("head", " ", -1))
    rows = rows.withColumn("whole", whole)
    numbers = [F.conv(F.substring("sha", 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)]
    nothing = [F.lit(None).cast("long")] * 7
    names = ["doc_id", "guest", "n_chars", "sha0", "sha1", "sha2", "sha3"]

    def part(kind, value, meta):
        return F.struct(F.lit(kind).alias("kind"), value.alias("part"),
                        *[m.cast("long").alias(n) for m, n in zip(meta, names, strict=True)])

    rest = F.lit(2 ** 31 - 1)
    parts = rows.select("bucket", "place", F.explode(F.array(
        part(0, F.substring(F.col("head"), F.lit(1), F.col("whole")), nothing),
        part(1, F.substring(F.col("text"), F.col("whole") + 1, rest), nothing),
        part(2, F.substring(F.col("edited"), F.col("whole") + 1, rest), nothing),
        part(3, F.lit(""), [F.col("doc_id"), F.col("guest"), F.col("n_chars"), *numbers]))).alias("p")).select("bucket", "place", "p.*")
    words = parts.select("bucket", "place", "kind", *names, F.explode(F.split("part", " ")).alias("word"))
    # Empty words stay as rows without weight: they carry the row's other columns.
    weights = words.groupBy("bucket", "place", "word").agg(
        F.sum(F.when(F.col("word") == "", 0).when(F.col("kind") <= 1, 1).otherwise(0)).alias("own"),
        F.sum(F.when(F.col("word") == "", 0).when((F.col("kind") == 0) | (F.col("kind") == 2), 1).otherwise(0)).alias("edited"),
        *[F.max(n).alias(n) for n in names])
    weights = weights.select(
        "bucket", "place", *names, F.xxhash64("word").alias("word"),
        F.when(F.col("own") > 0, F.log(F.col("own").cast("double"))).alias("w0"),
        F.when(F.col("edited") > 0, F.log(F.col("edited").cast("double"))).alias("w1"))
    least = [F.min(_sample(F.col("word"), F.col(w), k)).alias(f"{w}_{k}") for w in ("w0", "w1") for k in range(samples)]
    drawn = weights.groupBy("bucket", "place").agg(*[F.max(n).alias(n) for n in names], *least)
    digest = F.lower(F.concat(*[F.lpad(F.hex(f"sha{i}"), 16, "0") for i in range(4)]))
    return drawn.select(
        "bucket", "place", "doc_id", "guest", "n_chars", digest.alias("digest"),
        signature([F.col(f"w0_{k}") for k in range(samples)]).alias("fingerprint"),
        signature([F.col(f"w1_{k}") for k in range(samples)]).alias("edited_fingerprint"))


def weighted_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to each other and to the next document's.

    The edited text has its last third replaced by the start of the next
    document (see ``neighbours``).  Null and empty texts have an empty
    fingerprint, alike to each other and to nothing else.  Repeated rows give
    a row each; an empty table gives none; ids are whole numbers; other
    columns are not read.
    """
    drawn = fingerprint_pairs(neighbours(docs, doc_id, text), samples)
    order = Window.partitionBy("bucket").orderBy("place")
    return drawn.withColumn("after", F.lead("fingerprint").over(order)).where("guest = 0").select(
        F.col("doc_id").alias(doc_id), "n_chars", F.col("digest").alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("after", "fingerprint"), samples).alias("near_next"))


def op4_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op4_weighted_sampling": op4_weighted_sampling}
ORACLES: dict[str, str] = {}
