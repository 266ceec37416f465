"""Quality rules: word counts, and the fertility of public tokenizers.

A text is measured in one pass inside its own row.  Words are encoded once per
task and batch of words, so the tokenizers see distinct words only; no row is
shuffled, so a hot source or a group of copies weighs no more than its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vocab
from .common import Numbering, ship, table

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Rejection bands by script: characters per token, share of byte-fallback
#: pieces, bits of token entropy.  Scripts a vocabulary has few words of need
#: more tokens a character, so their bands reach lower.  The floor of characters
#: per token lies between what plain prose and what random letters of the script
#: measure (prose / random, two public vocabularies): Latin 1.97 to 4.1 / 1.0 to
#: 1.6, Cyrillic 2.07 / 1.2, Greek 1.74 / 1.06, Arabic 1.21 / 1.08, Hebrew
#: 1.49 / 1.11, Hangul 1.08 / 0.87, kana 1.07 / 0.82, Han 0.87 / 0.73, Thai
#: 1.03 / 0.78, Devanagari 0.80 / 0.59, Armenian 0.74 / 0.55.  Text in a script
#: that is only bytes to the vocabulary (private code points, emoji) is rejected.
BANDS = {
    "latin": {"chars_per_token": (1.75, 12.0), "byte_fallback": (0.0, 0.2), "entropy": (5.0, 20.0)},
    "cyrillic": {"chars_per_token": (1.65, 12.0), "byte_fallback": (0.0, 0.2), "entropy": (4.5, 20.0)},
    "greek": {"chars_per_token": (1.4, 12.0), "byte_fallback": (0.0, 0.2), "entropy": (4.5, 20.0)},
    "arabic": {"chars_per_token": (1.15, 12.0), "byte_fallback": (0.0, 0.2), "entropy": (4.5, 20.0)},
    "hebrew": {"chars_per_token": (1.3, 12.0), "byte_fallback": (0.0, 0.2), "entropy": (4.5, 20.0)},
    "hangul": {"chars_per_token": (0.97, 12.0), "byte_fallback": (0.0, 0.3), "entropy": (4.5, 20.0)},
    "kana": {"chars_per_token": (0.9, 12.0), "byte_fallback": (0.0, 0.4), "entropy": (4.5, 20.0)},
    "han": {"chars_per_token": (0.79, 12.0), "byte_fallback": (0.0, 0.4), "entropy": (4.5, 20.0)},
    "thai": {"chars_per_token": (0.9, 12.0), "byte_fallback": (0.0, 0.3), "entropy": (4.5, 20.0)},
    "devanagari": {"chars_per_token": (0.7, 12.0), "byte_fallback": (0.0, 0.3), "entropy": (4.2, 20.0)},
    "armenian": {"chars_per_token": (0.63, 12.0), "byte_fallback": (0.0, 0.3), "entropy": (4.2, 20.0)},
    "other": {"chars_per_token": (0.4, 12.0), "byte_fallback": (0.0, 0.9), "entropy": (4.0, 20.0)},
}
_LATIN = regex.compile(r"\p{Latin}")
#: Kana stand beside Han characters in a text, so the two are counted together and parted by a share of kana.
_SCRIPTS = {
    "cyrillic": regex.compile(r"\p{Cyrillic}"), "greek": regex.compile(r"\p{Greek}"), "arabic": regex.compile(r"\p{Arabic}"),
    "hebrew": regex.compile(r"\p{Hebrew}"), "hangul": regex.compile(r"\p{Hangul}"), "thai": regex.compile(r"\p{Thai}"),
    "devanagari": regex.compile(r"\p{Devanagari}"), "armenian": regex.compile(r"\p{Armenian}"),
    "han": regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]"),
}
_KANA = regex.compile(r"[\p{Hiragana}\p{Katakana}]")
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_tokens long, chars_per_token double, byte_fallback double, entropy double, script string")

#: A worker forgets its words between two texts beyond this many.
MAX_WORDS_KEPT = 250_000


class _Words:
    """Numbers, lengths and tokens of the distinct words a task has met."""

    def __init__(self, encoding, pieces) -> None:
        self.encoding, self.pieces = encoding, pieces
        every = range(pieces.get_piece_size())
        self.is_byte = np.array([pieces.is_byte(i) for i in every])
        self.opens = np.array([pieces.id_to_piece(i).startswith("\u2581") for i in every])
        self.forget()

    def forget(self) -> None:
        self.number = Numbering()
        self.chars = np.zeros(0, np.int64)
        self.piece_count = np.zeros(0, np.int64)
        self.byte_count = np.zeros(0, np.int64)
        self.token_at = np.zeros(1, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def learn(self) -> None:
        """Measure the words numbered since the last time."""
        texts = [w.decode("utf-8", "replace") for w in self.number.take()]
        if not texts:
            return
        tokens = [self.encoding.encode_ordinary(" " + t) for t in texts]
        sizes, bytes_in = self._pieces(texts)
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.chars = np.concatenate([self.chars, np.fromiter(map(len, texts), np.int64, len(texts))])
        self.piece_count = np.concatenate([self.piece_count, sizes])
        self.byte_count = np.concatenate([self.byte_count, bytes_in])
        self.token_at = np.concatenate([self.token_at, self.token_at[-1] + np.cumsum(lengths)])
        self.tokens = np.concatenate([self.tokens, np.fromiter(chain.from_iterable(tokens), np.int32, int(lengths.sum()))])

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and byte pieces of every word.

        Pieces never cross a space, so many words are encoded as one text and
        told apart by the pieces that open a word; should the vocabulary's
        normaliser have changed their number, each is encoded by itself.
        """
        ids = np.array(self.pieces.encode(" ".join(texts), num_threads=1), np.int64)
        first = np.flatnonzero(self.opens[ids])
        if len(first) != len(texts):
            if len(texts) > 1:
                half = len(texts) // 2
                return tuple(map(np.concatenate, zip(self._pieces(texts[:half]), self._pieces(texts[half:]), strict=True)))
            first = np.zeros(1, np.int64)
        if not len(ids):
            return np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        return np.diff(np.append(first, len(ids))), np.add.reduceat(self.is_byte[ids].astype(np.int64), first)

    def tokens_of(self, numbers: np.ndarray) -> np.ndarray:
        starts = self.token_at[numbers]
        lengths = self.token_at[numbers + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.tokens[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def script_of(text: str, raw: bytes) -> str:
    """The script most letters belong to; ``latin`` for a text without letters of a known one."""
    if len(raw) - len(text) <= len(text) // 5:  # nearly all ASCII
        return "latin"
    letters = sum(c.isalpha() for c in text)
    if 2 * len(_LATIN.findall(text)) >= letters:
        return "latin"
    counts = {name: len(pattern.findall(text)) for name, pattern in _SCRIPTS.items()}
    best = max(counts, key=counts.get)
    if 2 * counts[best] < letters:
        return "other"
    return "kana" if best == "han" and 5 * len(_KANA.findall(text)) >= counts[best] else best


def _window_keys(numbers: np.ndarray) -> np.ndarray:
    """A number for each 3-word window, equal for equal windows only, however many words there are."""
    if int(numbers.max()) < 1 << 21:
        return (numbers[:-2] << 42) | (numbers[1:-1] << 21) | numbers[2:]
    _, own = np.unique(numbers, return_inverse=True)  # below 2**31 words a text, two fit one key
    _, pairs = np.unique((own[:-1] << 31) | own[1:], return_inverse=True)
    return (pairs[:-1] << 31) | own[2:]


def repeated_words(numbers: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(numbers) < 4:
        return 0
    keys = _window_keys(numbers)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _measure(text: str, raw: bytes, numbers: np.ndarray, words: _Words) -> tuple:
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    if not len(numbers):
        return (0, 0, symbols, 0, 0, 0, 0.0, 0.0, 0.0, "latin")
    chars = int(words.chars[numbers].sum())
    tokens = words.tokens_of(numbers)
    counts = np.bincount(tokens)
    share = counts[counts > 0] / len(tokens)
    pieces = int(words.piece_count[numbers].sum())
    return (len(numbers), chars, symbols, duplicate_lines(raw), repeated_words(numbers), len(tokens),
            chars / len(tokens), int(words.byte_count[numbers].sum()) / max(1, pieces),
            float(-(share * np.log2(share)).sum()), script_of(text, raw))


def measure_texts(texts: list[str], words: _Words) -> list[tuple]:
    """The fields of ``SCHEMA`` for every text; the words of about a million characters are learnt at once."""
    out: list[tuple] = []
    group: list[tuple[str, bytes, np.ndarray]] = []
    size = 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "replace")
        group.append((text, raw, words.numbers(raw.split())))  # bytes split at exactly 0x20 and 0x09-0x0D
        size += len(raw)
        if size > 1_000_000 or i + 1 == len(texts):
            words.learn()
            out.extend(_measure(*one, words) for one in group)
            group, size = [], 0
            if len(words.number) > MAX_WORDS_KEPT:
                words.forget()
    return out


def measure(spark: SparkSession, byte_vocabulary: str = vocab.BYTE_BPE, piece_vocabulary: str = vocab.PIECE_BPE):
    """Pandas function from texts to the fields of ``SCHEMA``."""
    ship(spark)
    ranks, model = vocab.send(spark, byte_vocabulary), vocab.send(spark, piece_vocabulary)

    @F.pandas_udf(SCHEMA)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = _Words(vocab.byte_bpe(ranks.value), vocab.piece_bpe(model.value))
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        for texts in batches:
            yield pd.DataFrame(measure_texts(list(texts), words), columns=names)
    return measured


def _base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{m}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{m}.n_words"))


def _in_band(m: str, bands: dict) -> Column:
    fits = F.lit(True)
    for measure_name in ("chars_per_token", "byte_fallback", "entropy"):
        low, high = (F.create_map(*[x for s, b in bands.items() for x in (F.lit(s), F.lit(float(b[measure_name][i])))])
                     [F.col(f"{m}.script")] for i in (0, 1))
        fits = fits & F.col(f"{m}.{measure_name}").between(low, high)
    return fits


def judge_quality(docs: DataFrame, text: str = "text", bands: dict = BANDS, into: str = "quality_rules", **vocabularies) -> DataFrame:
    """``docs`` with a struct ``into`` of the measures, ``base_failed`` and ``kept``.

    A text of under 50 words, or with over half its words in repeated 3-word
    windows, fails the base rules; any other is kept if characters per token,
    byte-fallback share and token entropy (bits of the token histogram) lie in
    the bands of its script.  Null and empty texts have no words and fail.
    Repeated rows are judged each by itself; an empty table stays empty; a
    column named as ``into`` is replaced.
    """
    measured = docs.withColumn("__m", measure(docs.sparkSession, **vocabularies)(F.coalesce(F.col(text), F.lit(""))))
    failed = _base_failed("__m")
    fields = [f"__m.{f.split()[0]}" for f in SCHEMA.split(", ")]
    return measured.withColumn(into, F.struct(
        *fields, failed.alias("base_failed"), (~failed & _in_band("__m", bands)).alias("kept"))).drop("__m")


def op3_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), into="q")
    return judged.select("doc_id", *[f"q.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "byte_fallback", "entropy", "script")])


QUERIES = {"op3_tokenizer_fertility": op3_tokenizer_fertility}
ORACLES: dict[str, str] = {}
