"""Compare a Spark result with its SQL oracle, cell by cell."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET max_temp_directory_size = '2GB'")
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shown, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results hold the same rows, else what differs."""
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    theirs = canonical([d[0] for d in found.description], found.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} vs {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows vs {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if repr(a) != repr(b):
            bad = [(c, x, y) for c, x, y in zip(ours[0], a, b) if repr(x) != repr(y)]
            return f"first difference {bad} in {a}"
    return None
