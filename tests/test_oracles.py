"""Every registered report equals its SQL on another engine."""

import importlib.util
from pathlib import Path

import pytest
from compare import difference, oracle_connection
from conftest import SAMPLE

from ledgerloom.oracle import oracle_sql
from ledgerloom.plans.registry import QUERIES

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SAMPLE)


def test_every_report_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report_equals_oracle(spark, duck, name):
    assert difference(QUERIES[name](spark, SAMPLE), duck, ORACLES[name]) is None


def test_entry(spark):
    path = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("entry_point", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() == 200
    assert set(QUERIES) <= set(module.oracle_sql()) <= set(module.queries())


def test_no_oracle_cuts_its_tables():
    for name, sql in ORACLES.items():
        assert "p_partkey <" not in sql and "USING SAMPLE" not in sql.upper(), name
