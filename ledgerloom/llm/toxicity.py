"""Toxicity by a bidirectional gated recurrent network with attention, trained in numpy.

A text is cut into overlapping windows of words.  A word is the sum of what its
characters (hashed trigrams) and, for words of the training vocabulary, the
word itself contribute.  A forward and a backward GRU read a window, attention
pools their states and a logistic unit scores it; a text has the score of its
highest window.  The net is trained on a bounded sample of labelled rows and
sent to the tasks, which score whole texts row by row.  What score a logit
becomes is learnt by cross-fitting: every sampled document is scored, whole, by
a net that has not seen it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Numbering, ship, table

#: Words of a window, and words from one window's start to the next one's.
WINDOW, STRIDE = 32, 16
#: Bounds of the training sample: documents of each label, and windows of a document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 2000, 6
WIDTH, HIDDEN = 12, 8
TRIGRAMS = 1 << 13
VOCABULARY = 4000
#: Passes over the sample, and updates that a small sample's passes are raised to.
EPOCHS, UPDATES, BATCH, RATE, DECAY = 10, 800, 192, 0.01, 0.3
#: Share of words left out of a training window.
DROP = 0.1
#: Parts of the sample that are scored by a net trained on the others, at every size of the sample.
FOLDS = 3
#: Missed toxic texts that a clean text called toxic counts as: clean texts are the many, the sample has few of them.
ALARM_COST = 2
SEED = 7
THRESHOLD = 0.7
#: Distinct words a task keeps before it starts anew, and windows scored at once.
MAX_WORDS_KEPT, MAX_WINDOWS = 200_000, 4096

_WORDS = regex.compile(r"[\p{L}\p{N}]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def window_starts(n: int) -> list[int]:
    """Starts of the windows over n words: every ``STRIDE`` words, until one reaches the end."""
    return list(range(0, max(1, n - WINDOW + STRIDE), STRIDE)) if n else []


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams of all words, one word after the other, and how many each has."""
    padded = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    mixed = codes[:-2] * np.uint64(0x9E3779B1) ^ codes[1:-1] * np.uint64(0x85EBCA77) ^ codes[2:] * np.uint64(0xC2B2AE3D)
    mixed ^= mixed >> np.uint64(15)
    inside = np.ones(len(codes), bool)
    ends = np.cumsum(sizes)
    inside[ends - 1] = inside[ends - 2] = False
    return (mixed[inside[:-2]] % np.uint64(TRIGRAMS)).astype(np.int64), sizes - 2


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Net:
    """The network's weights; ``forward`` scores windows, ``step`` learns from them."""

    def __init__(self, vocabulary: list[str], rng: np.random.Generator) -> None:
        self.number = {w: i + 1 for i, w in enumerate(vocabulary)}  # 0: not in the vocabulary
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.p = {"word": small(len(vocabulary) + 1, WIDTH), "char": small(TRIGRAMS, WIDTH)}
        self.p["word"][0] = 0
        for side in "fb":
            self.p |= {f"W{side}": small(WIDTH, 3 * HIDDEN) * 3, f"U{side}": small(HIDDEN, 3 * HIDDEN) * 3,
                       f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": small(2 * HIDDEN, HIDDEN) * 3, "a": small(HIDDEN) * 3,
                   "o": small(2 * HIDDEN) * 3, "o0": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0
        self.m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.t = 0

    def vectors(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Input vectors of distinct words, and what their gradient needs."""
        ids = np.fromiter((self.number.get(w, 0) for w in words), np.int64, len(words))
        grams, sizes = trigrams(words)
        starts = np.cumsum(sizes) - sizes
        x = np.add.reduceat(self.p["char"][grams], starts, axis=0) / np.sqrt(sizes)[:, None].astype(np.float32)
        return (x + self.p["word"][ids]).astype(np.float32), (ids, grams, sizes)

    def projections(self, x: np.ndarray) -> np.ndarray:
        """Inputs of both GRUs' gates for distinct words, so a word costs them once; a last row of zeros pads."""
        both = np.concatenate([x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"]], axis=1)
        return np.concatenate([both, np.zeros((1, 6 * HIDDEN), np.float32)])

    def forward(self, projected: np.ndarray, windows: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of ``windows`` (steps x windows numbers of rows of ``projected``; padding last)."""
        steps, n = windows.shape
        h = HIDDEN
        mask = np.arange(steps)[:, None] < lengths
        states = np.zeros((steps, n, 2 * h), np.float32)
        trace = []
        for side, at in (("f", 0), ("b", 3 * h)):
            U = self.p[f"U{side}"]
            state = np.zeros((n, h), np.float32)
            for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
                x = projected[windows[t], at:at + 3 * h]
                gates = 0.5 * np.tanh(0.5 * (x[:, :2 * h] + state @ U[:, :2 * h])) + 0.5
                z, r = gates[:, :h], gates[:, h:]
                rh = r * state
                fresh = np.tanh(x[:, 2 * h:] + rh @ U[:, 2 * h:])
                moved = state + z * (fresh - state)
                after = np.where(mask[t][:, None], moved, state)
                if keep:
                    trace.append((side, t, state, z, r, rh, fresh))
                state = after
                states[t, :, 0 if side == "f" else h:h if side == "f" else 2 * h] = state
        hidden = np.tanh(states @ self.p["A"])
        energy = np.where(mask, hidden @ self.p["a"], -1e9)
        energy -= energy.max(axis=0)
        weight = np.exp(energy)
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", weight, states)
        logits = pooled @ self.p["o"] + self.p["o0"]
        return (logits, (states, mask, hidden, weight, pooled, trace)) if keep else logits

    def gradients(self, x, source, projected, windows, lengths, target, importance) -> tuple[dict, float]:
        """Gradients of the weighted logistic loss by going back through time."""
        h = HIDDEN
        logits, (states, mask, hidden, weight, pooled, trace) = self.forward(projected, windows, lengths, True)
        p = _sigmoid(logits)
        loss = float(-(importance * (target * np.log(p + 1e-7) + (1 - target) * np.log(1 - p + 1e-7))).mean())
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d = ((p - target) * importance / len(target)).astype(np.float32)
        g["o"], g["o0"] = pooled.T @ d, d.sum(keepdims=True)
        dpooled = d[:, None] * self.p["o"]
        dstates = weight[:, :, None] * dpooled
        dweight = np.einsum("tnk,nk->tn", states, dpooled)
        denergy = weight * (dweight - (weight * dweight).sum(axis=0))
        g["a"] = np.einsum("tn,tnh->h", denergy, hidden)
        dhidden = denergy[:, :, None] * self.p["a"] * (1 - hidden ** 2)
        g["A"] = np.einsum("tnk,tnh->kh", states, dhidden)
        dstates += dhidden @ self.p["A"].T
        dprojected = np.zeros_like(projected)
        carried, last = None, None
        for side, t, state, z, r, rh, fresh in reversed(trace):
            if side != last:
                carried, last = np.zeros_like(state), side
            at = 0 if side == "f" else 3 * h
            U = self.p[f"U{side}"]
            own = carried + dstates[t, :, 0 if side == "f" else h:h if side == "f" else 2 * h]
            live = mask[t][:, None]
            dmoved = np.where(live, own, 0)
            dfresh = dmoved * z * (1 - fresh ** 2)
            drh = dfresh @ U[:, 2 * h:].T
            dz = dmoved * (fresh - state) * z * (1 - z)
            dr = drh * state * r * (1 - r)
            dgates = np.concatenate([dz, dr], axis=1)
            g[f"U{side}"][:, :2 * h] += state.T @ dgates
            g[f"U{side}"][:, 2 * h:] += rh.T @ dfresh
            carried = np.where(live, dmoved * (1 - z) + drh * r + dgates @ U[:, :2 * h].T, own)
            np.add.at(dprojected[:, at:at + 3 * h], windows[t], np.concatenate([dgates, dfresh], axis=1))
        dprojected = dprojected[:-1]
        dx = np.zeros_like(x)
        for side, at in (("f", 0), ("b", 3 * h)):
            part = dprojected[:, at:at + 3 * h]
            g[f"W{side}"], g[f"c{side}"] = x.T @ part, part.sum(axis=0)
            dx += part @ self.p[f"W{side}"].T
        ids, grams, sizes = source
        np.add.at(g["word"], ids, dx)
        g["word"][0] = 0
        np.add.at(g["char"], grams, np.repeat(dx / np.sqrt(sizes)[:, None].astype(np.float32), sizes, axis=0))
        return g, loss

    def step(self, g: dict, rate: float) -> None:
        """One update by Adam; embeddings decay, so that what only one text taught fades."""
        self.t += 1
        for k, grad in g.items():
            first, second = self.m[k]
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            if k in ("word", "char"):
                self.p[k] *= np.float32(1 - rate * DECAY)
            self.p[k] -= (rate * (first / (1 - 0.9 ** self.t)) / (np.sqrt(second / (1 - 0.999 ** self.t)) + 1e-8)).astype(np.float32)


def _lay_out(windows: list[list[int]], padding: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in windows])
    out = np.full((len(windows), WINDOW), padding, np.int64)
    out[np.arange(WINDOW) < lengths[:, None]] = np.fromiter((i for w in windows for i in w), np.int64, int(lengths.sum()))
    return np.ascontiguousarray(out.T), lengths


def train(rows: list[tuple[int, int, list[str]]]) -> Net:
    """Net from (document, label, words of a window) rows, not yet calibrated.

    A toxic text is toxic somewhere, not everywhere: after a fifth of the passes
    only its highest windows teach label 1, the other windows do not count.
    """
    rng = np.random.default_rng(SEED)
    rows = sorted(rows)
    uses: dict[str, set[int]] = {}
    for doc, _, words in rows:
        for w in words:
            uses.setdefault(w, set()).add(doc)
    common = sorted((w for w, docs in uses.items() if len(docs) >= 3), key=lambda w: (-len(uses[w]), w))[:VOCABULARY]
    net = Net(common, rng)
    if not rows:
        net.shift = -2.0
        return net
    _start_from_counts(net, rows, uses)
    docs = np.array([r[0] for r in rows])
    labels = np.array([r[1] for r in rows], np.float32)
    place = np.unique(docs, return_inverse=True)[1]
    usable = np.ones(len(rows), bool)
    share = min(0.95, max(0.05, float(labels.mean())))
    importance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    epochs = max(EPOCHS, min(60, -(-UPDATES * BATCH // len(rows))))
    for epoch in range(epochs):
        if epoch >= epochs // 5:
            logits = score_windows(net, [r[2] for r in rows])
            top = np.full(place.max() + 1, -np.inf)
            np.maximum.at(top, place, logits)
            usable = (labels == 0) | (logits >= top[place] - 0.5)
        rate = RATE * min(1.0, 2.0 * (1 - epoch / epochs))
        order = rng.permutation(np.flatnonzero(usable))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            texts = [[w for w in rows[i][2] if rng.random() >= DROP] or rows[i][2] for i in chosen]
            listed = sorted({w for t in texts for w in t})
            number = {w: i for i, w in enumerate(listed)}
            x, source = net.vectors(listed)
            windows, lengths = _lay_out([[number[w] for w in t] for t in texts], len(listed))
            g, _ = net.gradients(x, source, net.projections(x), windows, lengths, labels[chosen], importance[chosen])
            net.step(g, rate)
    return net


def _start_from_counts(net: Net, rows: list, uses: dict[str, set[int]]) -> None:
    """One input of every word, and one of every trigram, start at its log-odds over documents.

    A small sample then need not find anew what plain counts tell.
    """
    toxic = {doc for doc, label, _ in rows if label == 1}
    clean = {doc for doc, label, _ in rows if label == 0}

    def odds(with_toxic, with_clean):
        return np.clip(np.log((with_toxic + 1) / (len(toxic) + 2)) - np.log((with_clean + 1) / (len(clean) + 2)), -3, 6)

    for word, i in net.number.items():
        n = len(uses[word] & toxic)
        net.p["word"][i, 0] = 0.5 * odds(n, len(uses[word]) - n)
    counts = np.zeros((2, TRIGRAMS))
    by_doc: dict[int, set[str]] = {}
    for doc, _, words in rows:
        by_doc.setdefault(doc, set()).update(words)
    for doc, words in by_doc.items():
        if words:
            counts[int(doc in toxic), np.unique(trigrams(sorted(words))[0])] += 1
    net.p["char"][:, 1] = 0.5 * odds(counts[1], counts[0])


def _calibrate(logit: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Scale and shift for which the best cut of the sample scores just the threshold.

    The cut is the one with the fewest misses and alarms, an alarm counting ``ALARM_COST`` times.
    """
    order = np.argsort(logit)
    ordered, real = logit[order], truth[order]
    missed = np.concatenate([[0], np.cumsum(real)])
    alarms = np.concatenate([np.cumsum((1 - real)[::-1])[::-1], [0]])
    cost = missed + ALARM_COST * alarms
    best = np.flatnonzero(cost == cost.min())
    low, high = ordered[max(0, best[0] - 1)], ordered[min(best[-1], len(ordered) - 1)]
    cut = float(low + 0.6 * (high - low))
    spread = float(max(np.std(logit), 0.1))
    return 2.0 / spread, float(np.log(THRESHOLD / (1 - THRESHOLD))) - 2.0 / spread * cut


def score_windows(net: Net, texts: list[list[str]]) -> np.ndarray:
    """Logits of windows given as words."""
    out = []
    for at in range(0, len(texts), MAX_WINDOWS):
        part = texts[at:at + MAX_WINDOWS]
        listed = sorted({w for t in part for w in t})
        number = {w: i for i, w in enumerate(listed)}
        x, _ = net.vectors(listed)
        out.append(net.forward(net.projections(x), *_lay_out([[number[w] for w in t] for t in part], len(listed))))
    return np.concatenate(out) if out else np.zeros(0)


class Scorer:
    """Scores of whole texts; words are projected once per task."""

    def __init__(self, net: Net) -> None:
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.number = Numbering()
        self.number[""] = 0  # no word is empty: row 0 pads
        self.projected = np.zeros((1, 6 * HIDDEN), np.float32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))

    def _learn(self) -> None:
        """Project the words numbered since the last time."""
        fresh = self.number.take()
        if fresh:
            self.projected = np.concatenate([self.projected, self.net.projections(self.net.vectors(fresh)[0])[:-1]])

    def scores(self, texts: list[str]) -> np.ndarray:
        """Score of every text from all of its windows; a text without a word scores 0."""
        best = self.logits(texts)
        score = _sigmoid(np.where(np.isneginf(best), 0.0, best) * self.net.scale + self.net.shift)
        return np.where(np.isneginf(best), 0.0, score)

    def logits(self, texts: list[str]) -> np.ndarray:
        """Highest logit of each text's windows; minus infinity without a word."""
        best = np.full(len(texts), -np.inf)
        stripes: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        waiting = 0
        for i, text in enumerate(texts):
            numbers = self._numbers(words_of(text))
            starts = np.array(window_starts(len(numbers)), np.int64)
            if not len(starts):
                continue
            padded = np.concatenate([numbers, np.zeros(WINDOW, np.int32)])
            stripes.append(padded[starts[:, None] + np.arange(WINDOW)])
            lengths.append(np.minimum(WINDOW, len(numbers) - starts))
            owners.append(np.full(len(starts), i))
            waiting += len(starts)
            if waiting >= MAX_WINDOWS or len(self.number) > MAX_WORDS_KEPT:
                self._flush(best, stripes, owners, lengths)
                waiting = 0
                if len(self.number) > MAX_WORDS_KEPT:
                    self.forget()
        if stripes:
            self._flush(best, stripes, owners, lengths)
        return best

    def _flush(self, best, stripes, owners, lengths) -> None:
        self._learn()
        windows, owner, length = np.concatenate(stripes), np.concatenate(owners), np.concatenate(lengths)
        for at in range(0, len(windows), MAX_WINDOWS):
            part = slice(at, at + MAX_WINDOWS)
            logits = self.net.forward(self.projected, np.ascontiguousarray(windows[part].T), length[part])
            np.maximum.at(best, owner[part], logits)
        stripes.clear()
        owners.clear()
        lengths.clear()


def training_documents(labels: DataFrame, label: str, sample_docs: int) -> DataFrame:
    """(doc_id, label, fold) of up to ``sample_docs`` documents of each label, those of the smallest hashes."""
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("label")).withColumn("at", F.xxhash64("doc_id", F.lit(SEED)))
    return chosen.where("label = 1").orderBy("at").limit(sample_docs).union(
        chosen.where("label = 0").orderBy("at").limit(sample_docs)).select(
        "doc_id", "label", F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(FOLDS)).cast("int").alias("fold"))


def training_windows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, label, fold, words) of up to ``SAMPLE_WINDOWS`` windows of the chosen documents, evenly over whole texts."""
    @F.pandas_udf("array<array<string>>")
    def windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for text in texts:
                words = words_of(text)
                starts = window_starts(len(words))
                if len(starts) > SAMPLE_WINDOWS:  # evenly over the whole text
                    starts = [starts[i * len(starts) // SAMPLE_WINDOWS] for i in range(SAMPLE_WINDOWS)]
                out.append([words[a:a + WINDOW] for a in starts])
            yield pd.Series(out, dtype=object)

    # At most 2 * sample_docs ids, so the join needs no shuffle of the texts.
    rows = docs.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "label", "fold", windows(F.coalesce(F.col("text"), F.lit(""))).alias("windows"))
    return rows.select("doc_id", "label", "fold", F.explode("windows").alias("words"))


def cross_fitted(docs: DataFrame, chosen: DataFrame) -> Net:
    """Net trained on all chosen documents; its scale and shift come from the nets trained without a fold.

    The nets are trained side by side, one a task.  Each document of the sample
    is scored over all windows of its whole text by the net that lacks its
    fold; one logit per document returns to the driver.
    """
    spark = docs.sparkSession
    rows = spark.sparkContext.broadcast([(r[0], r[1], r[2], list(r[3])) for r in training_windows(docs, chosen).collect()])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for fold in batch["id"]:
                net = train([(doc, label, words) for doc, label, own, words in rows.value if own != fold])
                net.m = {}
                yield pd.DataFrame({"fold": [fold], "net": [pickle.dumps(net)]})

    # No document is of fold FOLDS, so the last net has learnt from all.
    fitted = spark.range(0, FOLDS + 1, 1, FOLDS + 1).mapInPandas(fit, "fold long, net binary").collect()
    nets = {r["fold"]: pickle.loads(r["net"]) for r in fitted}
    parts = spark.sparkContext.broadcast([nets[i] for i in range(FOLDS)])

    @F.pandas_udf("double")
    def apart(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorers = [Scorer(net) for net in parts.value]
        for texts, folds in batches:
            out = np.full(len(texts), -np.inf)
            for i, scorer in enumerate(scorers):
                own = np.flatnonzero(folds.to_numpy() == i)
                out[own] = scorer.logits(list(texts.iloc[own]))
            yield pd.Series(out)

    told = docs.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "label", apart(F.coalesce(F.col("text"), F.lit("")), "fold").alias("logit")).groupBy("doc_id").agg(
        F.max("label").alias("label"), F.max("logit").alias("logit")).collect()
    told = [(r["logit"], r["label"]) for r in told if np.isfinite(r["logit"])]
    net = nets[FOLDS]
    if told:
        net.scale, net.shift = _calibrate(np.array([t[0] for t in told]), np.array([t[1] for t in told], float))
    return net


def held_out_rows(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1, higher for texts likelier to have label 1.

    Labels of held-out rows (see ``held_out_rows``) are never read.  Nothing
    but the text enters a score.  Null and empty texts, and those without a
    letter or digit, score 0; repeated rows score alike; without a usable label
    no text reaches the threshold; an empty table stays empty; a column
    named ``score`` is replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.where(~held_out_rows())
    net = cross_fitted(docs.select("doc_id", "text"), training_documents(known, label, sample_docs))
    weights = spark.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(weights.value)
        for texts in batches:
            yield pd.Series(scorer.scores(list(texts)))
    return docs.withColumn("score", scored(F.coalesce(F.col("text"), F.lit(""))))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", held_out_rows().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLES: dict[str, str] = {}
