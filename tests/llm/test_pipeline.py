"""Each stage of the pipeline against a plain version, on its own input."""

import corpus_pipeline
import pytest
from conftest import SAMPLE
from pyspark.sql import functions as F
from test_operators import plain_components, plain_simhash

from ledgerloom.llm import mixing, quality, vocab
from ledgerloom.llm.common import with_place


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of documents and of every stage, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SAMPLE).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality_keeps_what_the_rules_keep(stages):
    words = quality._Words(vocab.byte_bpe(open(vocab.BYTE_BPE, "rb").read()), vocab.piece_bpe(open(vocab.PIECE_BPE, "rb").read()))
    docs = rows(stages[0])
    kept = set()
    for d, r in docs.items():
        m = dict(zip([f.split()[0] for f in quality.SCHEMA.split(", ")], quality.measure_texts([r.text or ""], words)[0], strict=True))
        band = quality.BANDS[m["script"]]
        if m["n_words"] >= 50 and 100 * m["n_repeat_words"] <= 50 * m["n_words"] and all(band[k][0] <= m[k] <= band[k][1] for k in band):
            kept.add(d)
    assert set(rows(stages[1])) == kept
    assert all(rows(stages[1])[d] == docs[d] for d in kept)


def test_one_of_each_group_stays(stages):
    label = plain_components({d: plain_simhash(r.text) for d, r in rows(stages[1]).items()}, 3)
    assert set(rows(stages[2])) == set(label.values())


def test_secrets_are_masked_and_nothing_else(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert set(before) == set(after)
    for d, r in after.items():
        if "[SECRET]" not in r.text:
            assert r == before[d]
        else:
            assert r.n_chars == len(r.text)
            head, tail = r.text.split("[SECRET]")[0], r.text.split("[SECRET]")[-1]
            assert before[d].text.startswith(head) and before[d].text.endswith(tail)


def test_secret_stage_masks(spark):
    docs = spark.createDataFrame([(1, "a token = abcdefgh12 b", "en", "s", 22), (2, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    done = corpus_pipeline.secrets(spark, docs, SAMPLE)
    assert done.columns == docs.columns
    assert sorted(map(tuple, done.collect())) == [(1, "a [SECRET] b", "en", "s", 12), (2, None, None, None, None)]


def test_mix_keeps_rows_and_follows_the_weights(spark, stages):
    assert rows(stages[3]) == rows(stages[4])
    order = [r.source for r in mixing.mix_sources(stages[3]).orderBy("mix_slot", "mix_place").collect()]
    assert [r.source for r in corpus_pipeline.mix(spark, stages[3], SAMPLE).collect()] == order


def test_tokens_decode_to_the_texts(stages):
    import hashlib
    before, after = rows(stages[4]), rows(stages[5])
    assert set(before) == set(after)
    assert all(after[d].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for d, r in before.items())
    assert all(len(r.ids) == 4 * r.n_tokens for r in after.values())


def test_run_equals_the_stages(spark, stages):
    assert rows(corpus_pipeline.run(spark, SAMPLE)) == rows(stages[5])


def test_run_returns_the_order_of_the_mix(spark, stages):
    order = [r.doc_id for r in mixing.mix_sources(stages[3]).orderBy("mix_slot", "mix_place").collect()]
    for found in (corpus_pipeline.run(spark, SAMPLE), stages[5]):
        found = found.select("mix_position", "doc_id").orderBy("mix_position").collect()
        assert [tuple(r) for r in found] == list(enumerate(order))


def test_places_of_files_and_of_partitions(spark, tmp_path):
    rows = spark.range(1000, numPartitions=7).withColumn("text", F.repeat(F.lit("x"), (F.col("id") % 5 * 50).cast("int")))
    rows.write.option("maxRecordsPerFile", 30).parquet(f"{tmp_path}/t")
    for df in (rows, spark.read.parquet(f"{tmp_path}/t"), spark.createDataFrame([], rows.schema)):
        assert all(r.id == r.place for r in with_place(df, "place").collect())


def test_odd_rows_and_clashing_columns_pass_every_stage(spark):
    long = " ".join(f"word{i} stands here" for i in range(400))
    rows = [(1, None, None, None, None), (2, "", "en", "", 0), (None, long, "en", "a", len(long)), (None, long, "en", "a", len(long)),
            (3, long + " and more of it", None, None, 1), (4, "a token = abcdefgh12 b " + long, "en", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {c: F.lit(c) for c in ("mix_note", "mix_slot", "kept", "code", "secrets", "__source", "ids")})
    for of in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            done = stage(spark, of, SAMPLE)
            assert done.columns == docs.columns, name
            found = done.collect()
            assert all(r.mix_note == "mix_note" and r.mix_slot == "mix_slot" and r["__source"] == "__source" for r in found), name
            assert len(found) == (of.count() if name in ("secret scans", "mixing sources to target weights") else len(found))
        assert corpus_pipeline.tokens(spark, of, SAMPLE).count() == of.count()
