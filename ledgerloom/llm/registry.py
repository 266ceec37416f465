"""Queries and SQL of the operators of this subpackage."""

from __future__ import annotations

from . import bpe, chat, language, licenses, mixing, periodic, quality, secret_scan, simhash, toxicity, urls, weighted, whitening

MODULES = [urls, secret_scan, quality, simhash, bpe, chat, weighted, toxicity, mixing, licenses, whitening, language, periodic]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
