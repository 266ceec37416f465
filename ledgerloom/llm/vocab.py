"""Public vocabularies: read once on the driver, sent to the tasks as bytes.

A vocabulary file has under 2 MB whatever the corpus, so a broadcast is safe;
executors need no copy of the file.  A Python worker builds a tokenizer once.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession

BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN


def send(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


@lru_cache(maxsize=2)
def byte_bpe(content: bytes) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=parse_ranks(content), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all tokens' bytes one after the other, and each id's start and length."""
    by_rank = {rank: token for token, rank in parse_ranks(content).items()}
    tokens = [by_rank.get(i, b"") for i in range(max(by_rank) + 1)]
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


@lru_cache(maxsize=2)
def piece_bpe(content: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=content)
