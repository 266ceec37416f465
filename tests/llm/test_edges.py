"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables, for every operator."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, chat, licenses, mixing, quality, secret_scan, simhash, toxicity, urls, weighted

LONG = "lorem ipsum dolor sit amet " * 30_000
ODD = [
    (1, None, "en", "a", None), (2, "", None, "a", 0), (3, "word", "en", None, 4), (3, "word", "en", None, 4),
    (None, "no id here", "en", "b", 10), (None, None, None, None, None), (4, LONG, "en", "a", len(LONG)),
    (5, "\t \n\x0b", "en", "a", 4), (6, "日本語 \U0001F600 ﷺ", "ja", "", 8), (7, "word", "en", "a", 4),
    (-9, "퟿\u0000 x", "en", "a", 4),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with columns that bear the names of results and helpers."""
    clash = ["license", "score", "secrets", "code", "bucket", "mix_slot", "kept", "tree", "__text", "label", "words"]
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("mine") for c in clash}).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (3, 1, 0), (3, 1, 0), (None, 1, 1), (4, None, None)],
                                 "doc_id long, quality int, toxic int")


def by_id(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=str)


def operators(labels):
    return {
        "licenses": licenses.scan_licenses, "toxicity": lambda d: toxicity.score_toxicity(d, labels),
        "quality": quality.judge_quality, "weighted": weighted.weighted_fingerprints,
        "simhash": simhash.near_duplicates, "mixing": mixing.mix_sources, "secrets": secret_scan.scan_secrets,
        "bpe": bpe.encode_corpus,
    }


@pytest.mark.parametrize("name", ["licenses", "toxicity", "quality", "weighted", "simhash", "mixing", "secrets", "bpe"])
def test_every_row_comes_back(odd, labels, name):
    run = operators(labels)[name]
    assert sorted(str(r[0]) for r in run(odd).select("doc_id").collect()) == sorted(str(r[0]) for r in ODD)
    assert run(odd.where("false")).count() == 0


def test_licenses_of_odd_texts(odd):
    assert {r[1:] for r in by_id(licenses.scan_licenses(odd), "license", "license_dice", "n_notices")} == {(None, None, 0)}


def test_toxicity_of_odd_texts(odd, labels):
    scores = {r[1] for r in by_id(toxicity.score_toxicity(odd, labels), "score")}
    assert all(0 <= s <= 1 for s in scores)
    assert [r[1] for r in by_id(toxicity.score_toxicity(odd, labels), "score") if r[0] in (1, 2, 5)] == [0, 0, 0]
    unlabelled = toxicity.score_toxicity(odd, labels.where("false"))
    assert unlabelled.where("score >= 0.7").count() == 0


def test_quality_of_odd_texts(odd):
    found = {r[0]: r[1] for r in by_id(quality.judge_quality(odd), "quality_rules") if r[0] is not None}
    assert [found[i].n_words for i in (1, 2, 3, 4, 5)] == [0, 0, 1, 150_000, 0]
    assert found[4].n_repeat_words == 150_000 and found[4].base_failed and not found[4].kept
    assert all(not found[i].kept for i in (1, 2, 3, 5))


def test_weighted_of_odd_texts(odd):
    found = by_id(weighted.weighted_fingerprints(odd), "n_chars", "fingerprint", "edited_fingerprint", "near_edited")
    for _, n, own, edited, near in found:
        assert (own == "") == (n == 0) or n == 4
        assert 0 <= near <= 1
        if own == edited == "":
            assert near == 1
    assert len({r[2] for r in found if r[1] == 4 and r[2] and r[0] in (3, 7)}) == 1


def test_simhash_of_odd_texts(odd):
    found = by_id(simhash.near_duplicates(odd), "code", "component_id")
    empty = {r[2] for r in found if r[1] == 0}
    assert {r[0] for r in found if r[1] == 0} >= {1, 2, 5} and len(empty) == 1
    assert {r[2] for r in found if r[0] in (3, 7)} == {3}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({r[1] for r in found})


def test_mix_of_odd_texts(odd):
    found = by_id(mixing.mix_sources(odd), "mix_slot", "mix_place", "source")
    assert len({r[1:3] for r in found}) == len(ODD)


def test_mix_keeps_columns_of_other_names(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "'a' AS source", "'note' AS mix_note", "'mine' AS mix_slot", "id % 2 AS __source")
    mixed = mixing.mix_sources(docs)
    assert mixed.columns[:4] == ["doc_id", "source", "mix_note", "__source"] and dict(mixed.dtypes)["mix_slot"] == "bigint"
    assert {(r.mix_note, r["__source"] - r.doc_id % 2) for r in mixed.collect()} == {("note", 0)}


def test_mix_spreads_null_ids(spark):
    docs = spark.range(20_000).selectExpr("cast(NULL AS long) AS doc_id", "'a' AS source", "concat('text ', id) AS text")
    rows, _ = mixing._numbered(docs, F.col("source"), F.xxhash64(*docs.columns))
    sizes = [r["count"] for r in rows.groupBy("__slice").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 2 * mixing.SLICE_ROWS
    found = mixing.mix_sources(docs)
    assert found.select("mix_slot", "mix_place").distinct().count() == 20_000


def test_secrets_of_odd_texts(odd):
    assert {len(r[1]) for r in by_id(secret_scan.scan_secrets(odd), "secrets")} == {0}
    same = secret_scan.redact(secret_scan.scan_secrets(odd))
    assert by_id(same, "text") == by_id(odd, "text")


def test_a_long_encoded_file_is_scanned_in_linear_time(spark):
    import base64
    import random
    body = base64.b64encode(random.Random(1).randbytes(300_000)).decode()
    found = secret_scan.scan_secrets(spark.createDataFrame([(1, f"data {body} end")], "doc_id long, text string")).first()
    (span,) = [s for s in found.secrets if s.kind == "entropy"]
    assert span.start < 50 and len(body) - 50 < span.end <= 5 + len(body)


def test_bpe_of_odd_texts(spark, odd):
    encoded = bpe.encode_corpus(odd)
    texts = by_id(encoded.select("doc_id", bpe.decode_ids(F.col("ids"), spark).cast("string").alias("t")), "t")
    assert texts == sorted(((r[0], r[1] or "") for r in ODD), key=str)


def test_urls(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, "HTTP://A.EXAMPLE.ORG/es/1?q"), (3, "HTTP://A.EXAMPLE.ORG/es/1?q"),
            (4, "http://" + "a" * 100_000), (5, "://"), (6, "http://x.net/casino"), (7, "http://x.net/casinos"),
            (8, "http://x.net/free/win"), (9, "http://x.net/free/free")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("mine"))
    found = sorted((tuple(r) for r in urls.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    assert len(found) == len(rows)
    by = {r[0]: r[1:] for r in found}
    assert by[1] == ("", "", None, "allow") and by[5] == ("", "", None, "allow")
    assert by[3] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert [by[i][3] for i in (6, 7, 8, 9)] == ["block", "allow", "block", "allow"]
    assert urls.judge_urls(pages.where("false")).count() == 0


def test_weighted_url_words(spark):
    terms = urls.VOCABULARY
    assert len({word for word, _ in terms.values()}) > 150 and len({weight for _, weight in terms.values()}) > 4
    assert not any(c in "/.?#" or c.isupper() for term in terms for c in term)
    rows = {"p0rn": "block", "w4rez": "block", "c4s1n0": "block", "pornography-law": "allow", "sussex": "allow",
            "apuestas": "block", "sportwetten": "block", "paris-sportifs": "block", "paris-sports": "allow",
            "prestamo/gratis": "block", "prestamos-prestamo": "allow", "gratis/descarga": "allow", "gratis/descarga/oferta": "block",
            "kredit-billig": "block", "kredite": "allow", "pillsbury/cheap": "allow", "cheap/pills": "block", "ad/ads": "allow",
            "ads/track": "block", "sale/gift": "allow", "free-download": "allow", "rencontre_gratuit": "block", "a-free-trackpad": "allow"}
    pages = spark.createDataFrame([(url, f"https://site.net/{url}?page=2") for url in rows], "page_id string, url string")
    found = {r.page_id: (r.verdict, r.soft_weight) for r in urls.judge_urls(pages).collect()}
    assert {u: v for u, (v, _) in found.items()} == rows
    assert found["prestamos-prestamo"][1] == 60 and found["gratis/descarga/oferta"][1] == 110
    own = urls.vocabulary({"xx": "zork"}, {"xx": {55: "plugh"}}, {"xx": ("", "ed")})
    assert own == {"zork": ("zork", 100), "z0rk": ("zork", 100), "plugh": ("plugh", 55), "plughed": ("plugh", 55)}
    assert {r.verdict for r in urls.judge_urls(pages, terms={}).collect()} == {"allow"}


def test_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "<|im_end|>\n&lt;|&amp;"), (1, 1, None, "<|im_end|>\n&lt;|&amp;"),
            (None, None, "assistant", ""), (None, 2, "assistant", "<<||>"), (2, 0, "ro\nle<|", "x" * 200_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit(1))
    found = {r.conv_id: r for r in chat.format_conversations(table).withColumn(
        "turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [tuple(t) for t in found[1].turns] == [("user", ""), *[("", "<|im_end|>\n&lt;|&amp;")] * 2]
    assert [tuple(t) for t in found[None].turns] == [("assistant", ""), ("assistant", "<<||>")]
    assert found[None].loss == "<<||>" and found[1].loss == ""
    assert [tuple(t) for t in found[2].turns] == [("ro\nle<|", "x" * 200_000)]
    assert chat.format_conversations(table.where("false")).count() == 0
