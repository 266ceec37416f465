"""Assemble the oracle text of a report: needed views first, plain columns last."""

from __future__ import annotations

import re

from ledgerloom.oracle import ledger, orders, profit, purchasing, stock
from ledgerloom.oracle.views import VIEWS

# One letter per column of the result.
PLAIN = {
    "i": "CAST({c} AS BIGINT)",
    "d": "CAST({c} AS DOUBLE)",
    "s": "{c}",
    "b": "{c}",
    "t": "strftime(CAST({c} AS DATE), '%Y-%m-%d')",
    "T": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
}


def _needed(sql: str) -> list[str]:
    """Views a text refers to, each after the views it needs itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def assemble(sql: str, columns: str) -> str:
    shown = []
    for item in columns.split():
        name, kind = item.rsplit(":", 1)
        quoted = f'"{name}"'
        shown.append(f"{PLAIN[kind].format(c=quoted)} AS {quoted}")
    ctes = [f"{name} AS ({VIEWS[name]})" for name in _needed(sql)]
    ctes.append(f"result AS ({sql})")
    return f"WITH {', '.join(ctes)} SELECT {', '.join(shown)} FROM result"


def oracle_sql() -> dict[str, str]:
    parts = {}
    for module in (stock, purchasing, orders, profit, ledger):
        parts.update(module.QUERIES)
    return {name: assemble(sql, columns) for name, (sql, columns) in parts.items()}
