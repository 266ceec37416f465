"""Every operator against a plain version of what it computes."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import tiktoken
import xxhash
from compare import difference, oracle_connection
from conftest import SAMPLE
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, chat, licenses, mixing, quality, secret_scan, simhash, toxicity, vocab, weighted
from ledgerloom.llm.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SAMPLE)


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SAMPLE), duck, ORACLES[name]) is None


# --- licences

def test_anchors_lose_no_match():
    chosen = set(licenses.anchors(licenses.TEMPLATES))
    for grams in (licenses.bigrams_of(t) for ts in licenses.TEMPLATES.values() for t in ts):
        free = sum(not set(g.split()) & chosen for g in grams)
        assert free < math.ceil(len(grams) * 0.8 / 1.2 - 1e-9)


def test_notices_found_in_place(spark):
    notice = licenses.TEMPLATES["MIT"][3]
    rows = [(1, "abc.\nReleased under the  MIT license!\nxyz"), (2, notice.upper()), (3, f"first words here. {notice}\n\nmore"),
            (4, "Released under the terms."), (5, "Licensed under CC BY-NC 4.0. Other text follows.")]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id")
    assert [r.license for r in found.collect()] == ["MIT", "MIT", "MIT", None, "CC-BY-NC-4.0"]


def test_wrapped_and_commented_notices(spark):
    wrapped = ("We wrote these pages. This work is licensed under the GNU\nGeneral Public License, version 3. More words follow here, "
               "and more\nof them after that.")
    header = ("/*\n * Part of a program.\n *\n * This program is free software: you can redistribute it and/or modify\n"
              " * it under the terms of the GNU General Public License as published by\n"
              " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n *\n"
              " * This program is distributed in the hope that it will be useful, but\n * WITHOUT ANY WARRANTY; without even the "
              "implied warranty of\n * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n * details.\n */\nint main;\n")
    alone = "Text.\n\nThis work is licensed under the GNU\nGeneral Public License, version 2.\n\nText."
    rows = [(1, wrapped), (2, header), (3, header.replace(" *", "#").replace("/*", "#").replace("#/", "#")), (4, alone)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.license, r.n_notices) for r in found] == [("GPL-3.0", 1), ("GPL-3.0", 1), ("GPL-3.0", 1), ("GPL-2.0", 1)]


def test_near_wordings_are_not_mistaken(spark):
    clauses = licenses.TEMPLATES["BSD"][0]
    third = licenses.TEMPLATES["BSD-3-Clause"][2]
    grant = licenses.TEMPLATES["MIT-0"][2]
    creative = "This work is licensed under a Creative Commons Attribution-{} 4.0 International License."
    expected = {
        "Not released under the MIT License.": None,
        "This work is licensed under the GNU General Public License, version 4.": None,
        "Licensed under the Apache License, Version 1.1.": None,
        clauses: "BSD", f"{clauses}\n\n{third}": "BSD-3-Clause",
        f"{clauses}\n\n{third.replace('the copyright holder', 'Some Company')}": "BSD-3-Clause",
        f"{grant}\n\nTHE SOFTWARE IS PROVIDED AS IS": "MIT-0", licenses.TEMPLATES["MIT"][3]: "MIT",
        creative.format("NoDerivatives"): "CC-BY-ND-4.0", creative.format("NonCommercial-NoDerivatives"): "CC-BY-NC-ND-4.0",
        creative.format("NonCommercial-ShareAlike"): "CC-BY-NC-SA-4.0", creative.format("NonCommercial"): "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution 2.5 International License.": None,
        "# SPDX-License-Identifier: BSD-2-Clause\nimport os": "BSD-2-Clause", "// SPDX-License-Identifier: MIT": "MIT",
        "// SPDX-License-Identifier: MIT-0": "MIT-0", "SPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0",
        "SPDX-License-Identifier: LGPL-3.0": "LGPL-3.0", "SPDX-License-Identifier: CC-BY-NC-4.0": "CC-BY-NC-4.0",
        "SPDX-License-Identifier: Zlib": None,
    }
    found = licenses.scan_licenses(spark.createDataFrame(list(expected.items()), "text string, expected string")).collect()
    assert [(r.text, r.license) for r in found if r.license != r.expected] == []


def test_every_template_names_its_licence(spark):
    rows = [(name, t) for name, texts in licenses.TEMPLATES.items() for t in texts]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "name string, text string")).collect()
    assert [(r.name, r.text, r.license) for r in found if r.license != r.name or r.license_dice < 1] == []


def test_licence_sql_is_the_same_rule_on_wrapped_texts(spark, tmp_path):
    notices = [t for texts in licenses.TEMPLATES.values() for t in texts]
    rows = [(i, "Some words.\n" + t.replace(" ", "\n * ", 1 + i % 3) + " And more.\n \n" + notices[i * 7 % len(notices)]) for i, t in enumerate(notices)]
    rows += [(10_000 + i, f"{t}\n{t}  \n# {t}") for i, t in enumerate(notices)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    import duckdb
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    found = licenses.scan_licenses(docs).select("doc_id", "license", "license_dice", "n_notices")
    assert difference(found, con, ORACLES["op1_license_scan"]) is None


# --- toxicity

def test_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.Net(["aa", "bb"], rng)
    words = ["aa", "bb", "cc"]
    windows, lengths = toxicity._lay_out([[0, 1, 2], [2, 1]], 3)
    target, importance = np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        x, source = net.vectors(words)
        return net.gradients(x.astype(np.float64), source, net.projections(x).astype(np.float64), windows, lengths, target, importance)

    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    g, _ = loss()
    for k, at in (("Uf", (1, 2)), ("Ub", (2, 20)), ("Wf", (3, 4)), ("cb", (5,)), ("A", (1, 1)), ("a", (2,)), ("o", (9,)), ("word", (1, 3))):
        kept = net.p[k][at]
        net.p[k][at] = kept + 1e-3
        up = loss()[1]
        net.p[k][at] = kept - 1e-3
        down = loss()[1]
        net.p[k][at] = kept
        assert abs((up - down) / 2e-3 - g[k][at]) < 2e-3 * max(1, abs(g[k][at])) + 2e-4, k


def test_toxicity_logits_equal_a_plain_forward_pass():
    rng = np.random.default_rng(5)
    net = toxicity.Net(["alpha", "beta", "gamma"], rng)
    p, h = {k: v.astype(float) for k, v in net.p.items()}, toxicity.HIDDEN
    gate = lambda x: 1 / (1 + np.exp(-x))

    def states(side, words):
        state, out = np.zeros(h), []
        for word in words:
            x = net.vectors([word])[0][0] @ p[f"W{side}"] + p[f"c{side}"]
            z = gate(x[:h] + state @ p[f"U{side}"][:, :h])
            r = gate(x[h:2 * h] + state @ p[f"U{side}"][:, h:2 * h])
            state = (1 - z) * state + z * np.tanh(x[2 * h:] + (r * state) @ p[f"U{side}"][:, 2 * h:])
            out.append(state)
        return out

    def logit(words):
        both = np.hstack([states("f", words), states("b", words[::-1])[::-1]])
        weight = np.exp(np.tanh(both @ p["A"]) @ p["a"])
        return (weight / weight.sum()) @ both @ p["o"] + p["o0"][0]

    texts = [[str(w) for w in rng.choice(["alpha", "beta", "gamma", "delta", "word", "x"], n)] for n in (1, 15, 32, 33, 100)]
    expected = [max(logit(t[a:a + toxicity.WINDOW]) for a in toxicity.window_starts(len(t))) for t in texts]
    assert np.allclose(toxicity.Scorer(net).logits([" ".join(t) for t in texts] + [""]), [*expected, -np.inf], atol=1e-4)


def _toxic_rows(rng, n):
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 150))]
        toxic = i % 4 == 0
        for _ in range(4 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["wretch", "scoundrel", "villain"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = _toxic_rows(random.Random(3), 1200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(docs, labels).withColumn("held", toxicity.held_out_rows()).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [(r.score >= 0.7, truth[r.doc_id]) for r in scored if r.held]
    assert len(held) > 300
    assert sum(p == t for p, t in held) / len(held) > 0.97


def test_windows_reach_every_word():
    for n in [*range(1, 100), 777]:
        covered = set()
        for a in toxicity.window_starts(n):
            covered |= set(range(a, min(n, a + toxicity.WINDOW)))
        assert covered == set(range(n))


# --- quality

def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(spark, texts):
    found = QUERIES["op3_tokenizer_fertility"](spark, SAMPLE).collect()
    encoding = vocab.byte_bpe(open(vocab.BYTE_BPE, "rb").read())
    pieces = vocab.piece_bpe(open(vocab.PIECE_BPE, "rb").read())
    assert len(found) == len(texts)
    for r in found:
        text = texts[r.doc_id]
        base = plain_quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        ids = [i for w in words for i in encoding.encode_ordinary(" " + w)]
        assert r.n_tokens == len(ids)
        if not words:
            continue
        share = np.array(list(Counter(ids).values())) / len(ids)
        assert r.chars_per_token == pytest.approx(base[1] / len(ids))
        assert r.entropy == pytest.approx(-(share * np.log2(share)).sum())
        of = [i for w in words for i in pieces.encode(w)]
        assert r.byte_fallback == pytest.approx(sum(map(pieces.is_byte, of)) / len(of))
        band = quality.BANDS[r.script]
        assert r.kept == (not r.base_failed and all(
            band[k][0] <= v <= band[k][1] for k, v in (("chars_per_token", r.chars_per_token), ("byte_fallback", r.byte_fallback), ("entropy", r.entropy))))


def test_clean_documents_stay(spark, duck):
    clean = {r[0] for r in duck.execute(
        "SELECT doc_id FROM labels JOIN documents USING (doc_id) WHERE quality = 1 AND len(string_split_regex(text, '\\s+')) >= 52").fetchall()}
    kept = {r.doc_id for r in QUERIES["op3_tokenizer_fertility"](spark, SAMPLE).where("kept").collect()}
    assert clean and not clean - kept


def test_scripts():
    for text, script in (("été " * 9, "latin"), ("слово", "cyrillic"), ("日本語の", "han"), ("λόγος", "greek"), ("كلمة", "arabic"), ("สวัสดี", "other"), ("12", "latin")):
        assert quality.script_of(text, text.encode()) == script


# --- weighted sampling

def test_signatures_estimate_weighted_jaccard(spark, texts):
    found = {r.doc_id: r for r in weighted.weighted_fingerprints(spark.read.parquet(f"{SAMPLE}/documents.parquet"), samples=48).collect()}
    ids = sorted(texts, reverse=True)
    words = lambda t: Counter(t.encode().split())
    likeness = lambda a, b: sum((a & b).values()) / max(1, sum((a | b).values()))
    off = []
    for i, d in enumerate(ids):
        own, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        cut = len(own) // 3
        edited = own[:len(own) - cut] + after[:cut]
        assert found[d].n_chars == len(own)
        assert found[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        off.append(found[d].near_edited - likeness(words(own), words(edited)))
        off.append(found[d].near_next - likeness(words(own), words(after)))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.08
    for same in [[d for d in ids if texts[d] == t] for t in set(texts.values())]:
        assert len({found[d].fingerprint for d in same}) == 1


def test_neighbours_over_many_buckets(spark):
    rows = [(i * i, f"t{i} x y") for i in range(500)] + [(None, "n"), (4, "again")]
    got = weighted.neighbours(spark.createDataFrame(rows, "doc_id long, text string")).where("guest = 0").collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    after = {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    for r in got:
        if r.doc_id != 4 and after[r.text] not in ("again", "t2 x y"):
            assert r.next_text == after[r.text]
    assert len(got) == len(rows)


# --- chat

def test_paths_of_random_trees(spark):
    rng = random.Random(5)
    rows, parent_of, score_of = [], {}, {}
    for tree in range(12):
        for node in range(rng.choice([1, 2, 9, 70])):
            parent = rng.randrange(max(0, node - 3), node) if node else None
            score = rng.randrange(5)
            rows.append((tree, node, parent, float(score)))
            parent_of[tree, node], score_of[tree, node] = parent, score
    rows += [(99, 1, 2, 1.0), (99, 2, 1, 1.0), (98, 5, 77, 1.0)]  # a circle, and a missing parent
    parent_of[98, 5], score_of[98, 5] = None, 1
    paths = defaultdict(list)
    for tree, node in parent_of:
        if not any(t == tree and p == node for (t, _), p in parent_of.items()):
            way, at = [], node
            while at is not None:
                way.append(at)
                at = parent_of[tree, at]
            mean = sum(score_of[tree, n] for n in way) / len(way)
            paths[tree].append((-mean, -len(way), node, way[::-1]))
    expected = {(t, p[2], i + 1): p[3] for t, ps in paths.items() for i, p in enumerate(sorted(ps)[:2])}
    got = defaultdict(list)
    frame = spark.createDataFrame(rows, "tree long, node long, parent long, score double")
    for r in chat.reply_paths(frame, best=2).orderBy("place").collect():
        got[r.tree, r.leaf, r.rank].append(r.node)
    assert dict(got) == expected


# --- SimHash

def plain_simhash(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, bits):
    label = {d: d for d in codes}
    changed = True
    while changed:
        changed = False
        for a in codes:
            for b in codes:
                if label[a] > label[b] and (codes[a] ^ codes[b]).bit_count() <= bits:
                    label[a], changed = label[b], True
    return label


def test_simhash_components(spark, texts):
    codes = {d: plain_simhash(t) for d, t in texts.items()}
    label = plain_components(codes, 3)
    found = QUERIES["op6_simhash_gray"](spark, SAMPLE).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in found} == {d: (codes[d], label[d]) for d in texts}


@pytest.mark.parametrize("max_bucket", [40, 100_000])
def test_crowded_buckets_lose_no_link(spark, max_bucket):
    rng = random.Random(2)
    codes = set()
    for centre in (rng.getrandbits(64) for _ in range(5)):
        for _ in range(150):
            code = centre
            for _ in range(rng.randrange(4)):
                code ^= 1 << rng.randrange(64)
            codes.add(code)
    codes = sorted(codes)
    signed = lambda c: c - (1 << 64) if c >> 63 else c
    links = simhash.near_links(spark.createDataFrame([(signed(c),) for c in codes], "code long"), 3, max_bucket).collect()
    label = plain_components(dict(enumerate(codes)), 3)
    place = {signed(c): i for i, c in enumerate(codes)}
    group = list(range(len(codes)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in links:
        x, y = sorted((root(place[a]), root(place[b])))
        group[y] = x
    assert [root(i) for i in range(len(codes))] == [label[i] for i in range(len(codes))]


def test_index_finds_all_near_codes():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)[rng.integers(0, 60, 3000)]
    for _ in range(4):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)) * (rng.random(3000) < 0.6)
    index = simhash.GrayIndex(np.unique(codes))
    a, b = index.search(index.codes, 3)
    near = np.bitwise_count(index.codes[:, None] ^ index.codes[None, :]) <= 3
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(*np.nonzero(near), strict=True))


# --- mixing

def test_mix_places_every_block_once(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}") for i in range(5000)]
    weights = {"hot": 1.0, "s0": 3.0, "s1": 0.5}
    found = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), weights, block=4).collect()
    assert sorted(r.doc_id for r in found) == list(range(5000))
    share = lambda s: s if s in weights else mixing.OTHERS
    per_slot = defaultdict(set)
    for r in found:
        per_slot[r.mix_slot].add((share(r.source), r.mix_block))
        assert r.mix_release <= r.mix_slot < r.mix_deadline
    assert sorted(per_slot) == list(range(len(per_slot))) and all(len(v) == 1 for v in per_slot.values())
    assert len({(r.mix_slot, r.mix_place) for r in found}) == 5000


@pytest.mark.parametrize("weights", [{"a": 0.9, "b": 0.1}, {"a": 100.0, **{f"s{i}": 1.0 for i in range(100)}}, {"a": 1.0, "b": 0.0004}])
def test_deviation_from_given_weights_over_many_periods(weights):
    names = sorted(weights)
    fluid = mixing.Fluid([10 ** 9] * len(names), mixing.whole([weights[n] for n in names]))
    total, given = sum(weights.values()), Counter()
    for slot, s, block, release, deadline in fluid.serve([0] * len(names), 0, 20_000):
        assert block == given[s] and release <= slot < deadline
        given[s] += 1
        if slot % 37 == 0 or slot > 19_990:
            assert all(abs(given[i] - (slot + 1) * weights[n] / total) < 1 + 1e-6 for i, n in enumerate(names))


def test_segments_lay_out_one_schedule(spark, monkeypatch):
    blocks, weights = {"a": 700, "b": 90, "c": 3, "d": 0}, {"a": 0.7, "b": 1 / 3, "c": 0.0123, "d": 1.0}
    monkeypatch.setattr(mixing, "SEGMENT", 100)
    found = sorted(tuple(r) for r in mixing._schedule(spark, blocks, weights).collect())
    fluid = mixing.Fluid([700, 90, 3], mixing.whole([0.7, 1 / 3, 0.0123]))
    assert found == sorted(("abc"[s], i, slot, r, d) for slot, s, i, r, d in fluid.serve([0, 0, 0], 0, 793))
    assert sorted(r[2] for r in found) == list(range(793)) and all(r[3] <= r[2] < r[4] for r in found)


@pytest.mark.parametrize("seed", range(40))
def test_a_segment_finds_the_state_of_the_one_schedule(seed):
    draw = random.Random(seed)
    blocks = [draw.choice([1, 2, draw.randint(1, 60), draw.randint(1, 200)]) for _ in range(draw.randint(1, 9))]
    weights = [draw.choice([1.0, b ** 0.5, draw.random() + 0.001, 0.001, 100.0]) for b in blocks]
    fluid, done = mixing.Fluid(blocks, mixing.whole(weights)), [0] * len(blocks)
    for slot, s, _, release, deadline in fluid.serve(done, 0, sum(blocks)):
        assert fluid.state(slot) == done and release <= slot < deadline
        assert deadline - release <= fluid.longest() + 1
        done[s] += 1
    assert fluid.state(sum(blocks)) == done == blocks


@pytest.mark.parametrize("blocks", [[9_000_000, 1_000_000, 37, 1], [10 ** 12 // (k + 1) ** 2 + 1 for k in range(300)]])
def test_deviation_far_into_many_blocks(blocks):
    weights = [float(b) ** 0.5 for b in blocks]
    fluid, total = mixing.Fluid(blocks, mixing.whole(weights)), sum(blocks)
    for first in (0, 12_345, total // 3, total - 2_000):
        done = fluid.state(first)
        assert sum(done) == first
        for slot, s, block, release, deadline in fluid.serve(done, first, first + 2_000):
            assert block == done[s] and release <= slot < deadline
            done[s] += 1
            if slot % 97 == 0:
                served, per = fluid.ideal(slot + 1)
                assert all(abs(d - min(b, Fraction(w * served, per))) < 1 for d, b, w in zip(done, blocks, fluid.weights, strict=True))
        assert fluid.state(first + 2_000) == done


def test_the_driver_does_not_walk_through_blocks(spark, monkeypatch):
    def walk(*_):
        raise AssertionError("the driver laid blocks out")
    with monkeypatch.context() as driver:
        driver.setattr(mixing.Fluid, "serve", walk)
        driver.setattr(mixing.Fluid, "state", walk)
        plan = mixing._schedule(spark, {"a": 10 ** 12, "b": 10 ** 11, "c": 5}, {"a": 3.0, "b": 1.0, "c": 0.1})
    assert plan.rdd.getNumPartitions() == mixing.TASKS


@pytest.mark.parametrize("weighted", [False, True])
def test_every_one_of_many_sources_has_its_share(spark, weighted):
    rows = [(i, f"s{i % 150}") for i in range(2400)] + [(9000 + i, "hot") for i in range(1600)]
    weights = {f"s{i}": 1.0 + i / 50 for i in range(150)} | {"hot": 40.0} if weighted else None
    found = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), weights, block=1).collect()
    sizes = Counter(s for _, s in rows)
    share = weights or {s: c ** 0.5 for s, c in sizes.items()}
    assert sorted(r.mix_slot for r in found) == list(range(4000))
    total = sum(share.values())
    for s in sizes:  # no source runs out within the first 300 slots
        own = sorted((r.mix_block, r.mix_slot) for r in found if r.source == s)
        assert [b for b, _ in own] == list(range(sizes[s]))
        assert all(abs(sum(x < t for _, x in own) - t * share[s] / total) < 1 + 1e-6 for t in range(0, 300, 7))


# --- secrets

def test_spans_point_at_their_text(spark):
    key = "kJ8vQz2XpL5nR7tW9yB4mC6dF1gH3sA0"
    text = f"é\U0001F600 token = 'abcdefgh12' AKIA{'A1' * 8}\n{'0a' * 20} x {key} end {'a1b2' * 8} password: short"
    row = secret_scan.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    spans = [(s.kind, text[s.start:s.end]) for s in row.first().secrets]
    assert ("assign", "token = 'abcdefgh12") in spans and ("access", "AKIA" + "A1" * 8) in spans
    assert ("hex", "0a" * 20) in spans and ("hex", "a1b2" * 8) in spans
    assert [t for k, t in spans if k == "entropy"] == [key]
    clean = secret_scan.redact(row).first().text
    assert clean == "é\U0001F600 [SECRET]' [SECRET]\n[SECRET] x [SECRET] end [SECRET] password: short"


@pytest.mark.parametrize("before", ["=====", "-----", "example_key=", "/home/u/", "/home/u/example/", "placeholder-0123456789-"])
def test_public_parts_do_not_hide_a_key(spark, before):
    key = "9fQ2xLk7Vb3NzT1yRwP8mC4d"
    row = secret_scan.scan_secrets(spark.createDataFrame([(1, f"see {before}{key} there")], "doc_id long, text string"))
    assert row.first().secrets and key not in secret_scan.redact(row).first().text


def test_digits_are_flagged_and_public_strings_are_not(spark):
    rows = [(1, "pin 83920174650291837465 end"), (2, "id 123e4567-e89b-12d3-a456-426614174000 end"), (3, "run 01234567890123456789 end"),
            (4, "at /usr/share/doc/python3/readme-2 end"), (5, "ab1-ab1-ab1-ab1-ab1-ab1- end"), (6, "my-example-placeholder-changeme-1 end")]
    found = secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [len(r.secrets) for r in found] == [1, 0, 0, 0, 0, 0]


def plain_high(v):
    """Stretches that high windows of 20 cover, each window by the class of its own characters."""
    out = []
    for i in range(len(v) - 19):
        w = v[i:i + 20]
        limit = (secret_scan.BITS["digits"] if re.fullmatch("[0-9]+", w) else secret_scan.BITS["hex"] if re.fullmatch("[0-9a-f]+|[0-9A-F]+", w)
                 else secret_scan.BITS["upper"] if re.fullmatch("[A-Z0-9]+", w) else secret_scan.BITS["base64"])
        bits = -sum(c / 20 * math.log2(c / 20) for c in Counter(w).values())
        if " " not in w and bits > limit:
            if out and i - out[-1][1] < secret_scan.JOIN:
                out[-1] = (out[-1][0], i + 20)
            else:
                out.append((i, i + 20))
    return [(a, b) for a, b in out if re.search("[0-9]", v[a:b])]


def test_entropy_by_plain_windows(spark):
    rng = random.Random(4)
    pools = ["0123456789", "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
             "abcdefgh0123456789XYZ+/", "ab1", "kJ8vQz2XpL5nR7tW9yB4mC6dF1gH3sA0 "]
    values = ["".join(rng.choice(rng.choice(pools[:rng.randint(1, 7)]) if rng.random() < 0.3 else pool) for _ in range(rng.randint(20, 90)))
              for pool in pools for _ in range(12)]
    values += ["9fQ2xLk7Vb3NzT1yRwP8mC4d" + "=" * 34 + "kJ8vQz2XpL5nR7tW9yB4mC6dF1gH3sA0"]
    found = spark.createDataFrame([(v,) for v in values], "v string").select("v", secret_scan.high_entropy_spans(F.col("v")).alias("s")).collect()
    assert {r.v: [tuple(s) for s in r.s] for r in found} == {v: plain_high(v) for v in values}
    assert len(plain_high(values[-1])) == 2  # two keys, two spans
    assert sum(bool(plain_high(v)) for v in values) > 20


ORDINARY = [
    "https://shop.org/en/2024/05/how-to-bake-sourdough-bread-quickly", "/home/user42/files/Quarterly_Report_2024_Final",
    "call 555-0123-4567-890-2345-678 now", "ISBN 978-0-306-40615-7-978-0-14-032872-1", "2024-01-01-2024-02-29-2025-12-31",
    "getElementsByClassName2", "internationalization18", "covid19vaccinationstatistics", "AdvancedEncryptionStandard256",
    "win32applicationframework2", "image_20240101_123456_final_version_2", "com/example/android/version2/MainActivity",
    "my-very-long-package-name-version-12", "chapter1_section2_paragraph3_line4", "2001-06-30T10-00-00-000Z-2001-07-30",
]


def test_ordinary_strings_are_left_alone(spark):
    docs = spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate(ORDINARY)], "doc_id long, text string")
    flagged = [ORDINARY[r.doc_id] for r in secret_scan.scan_secrets(docs).collect() if r.secrets]
    assert flagged == []


def test_many_spans_take_linear_time(spark):
    import time
    rng = random.Random(6)
    hexes = ["%032x" % rng.getrandbits(128) for _ in range(100_000)]
    keys = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40)) for _ in range(300)]
    docs = spark.createDataFrame([(1, "\n".join(hexes)), (2, " ".join(keys))], "doc_id long, text string")
    start = time.perf_counter()
    done = {r.doc_id: r for r in secret_scan.redact(secret_scan.scan_secrets(docs)).collect()}
    assert time.perf_counter() - start < 120
    assert len(done[1].secrets) == 100_000 and done[1].text == "\n".join(["[SECRET]"] * 100_000)
    assert [(s.start, s.end) for s in done[1].secrets[99_998:]] == [(33 * 99_998, 33 * 99_998 + 32), (33 * 99_999, 33 * 99_999 + 32)]
    assert len(done[2].secrets) > 270


def test_running_sums_and_maxima_over_many_blocks(spark):
    rng = random.Random(2)
    rows = [(n, [rng.randrange(1000) for _ in range(n)]) for n in (0, 1, 127, 128, 129, 1000)]
    found = spark.createDataFrame(rows, "n int, v array<bigint>").select(
        "n", secret_scan._running(F.col("v"), lambda x, y: x + y).alias("s"), secret_scan._running(F.col("v"), lambda x, y: F.greatest(x, y), -1).alias("m"))
    from itertools import accumulate
    for r in found.collect():
        values = dict(rows)[r.n]
        assert r.s == list(accumulate(values)) and r.m == list(accumulate(values, max))


# --- BPE

def test_ids_equal_the_library(spark, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocab.BYTE_BPE, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in QUERIES["op10_byte_bpe"](spark, SAMPLE).collect()}
    for d, text in texts.items():
        ids = encoding.encode_ordinary(text)
        assert found[d].n_tokens == len(ids)
        assert found[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_small_chunks_and_string_keys(spark):
    rows = [(f"k{i}", f"word{i % 5} the the <|endoftext|> {'x' * i}") for i in range(300)]
    found = bpe.encode_corpus(spark.createDataFrame(rows, "name string, body string").repartition(4), "name", "body", chunk_chars=500)
    back = found.select("name", bpe.decode_ids(F.col("ids"), spark).cast("string").alias("t")).collect()
    assert {tuple(r) for r in back} == set(rows)
