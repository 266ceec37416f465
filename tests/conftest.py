from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from ledgerloom.model import Model  # noqa: E402
from ledgerloom.schemas import TABLES  # noqa: E402
from ledgerloom.session import get_session  # noqa: E402

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxMetadataStringLength": "10000",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample(spark):
    return Model.from_star(spark, SAMPLE)


@pytest.fixture(scope="session")
def table(spark):
    """Small table with the columns of an ERP table; missing fields are NULL."""
    def build(name: str, *rows: dict):
        schema = TABLES[name]
        empty = spark.createDataFrame([], schema)
        return spark.createDataFrame(
            [tuple(row.get(f.name) for f in empty.schema) for row in rows], empty.schema)
    return build


def d(text: str) -> date:
    return date.fromisoformat(text)


def n(value) -> Decimal:
    return Decimal(str(value))


def move(item="A-1", on="2024-01-01", doc="GRN-1", qty=1, val=10, zid=100002, sign=None, line=1,
         wh="Main", sup="S1"):
    sign = sign if sign is not None else (1 if doc[:4] in ("GRN-", "SRE-") else -1)
    return dict(zid=zid, xitem=item, xdate=d(on), xdocnum=doc, xline=line, xsup=sup, xsign=sign,
                xqty=n(qty), xval=n(val), xwh=wh, xyear=int(on[:4]), xper=int(on[5:7]))


def item(code="A-1", zid=100002, price=10, desc="thing", group="G"):
    return dict(zid=zid, xitem=code, xdesc=desc, xgitem=group, xbrand="B", xstdprice=n(price))


def rows(df, *columns):
    """Rows as tuples in a stable order."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=str)
