"""The ERP tables an operator asks for, wherever they come from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions.columns import doc_is
from ledgerloom.schemas import TABLES
from ledgerloom.sources.readers import read_table
from ledgerloom.sources.star import Star

STORE, CENTRAL, ECOMMERCE = 100001, 100002, 100003


class Model:
    """Lazy tables as attributes: ``m.imtrn``, ``m.caitem``, ...

    Keys are unique only within a unit, so every join carries ``zid``.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, Callable[[], DataFrame]],
                 movements_of: Callable[[str], DataFrame] | None = None):
        self.spark = spark
        self._movements_of = movements_of
        self._tables = tables
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("_tables", {})
        if name not in tables:
            raise AttributeError(f"no table {name!r}")
        if name not in self._built:
            self._built[name] = tables[name]()
        return self._built[name]

    def movements_of(self, prefix: str) -> DataFrame:
        """Movements of one document type, by stored columns where the source can test those."""
        of_type = self.__dict__.get("_movements_of")
        return of_type(prefix) if of_type else self.imtrn.filter(doc_is(prefix))

    def replace(self, **frames: DataFrame) -> Model:
        """Same model with some tables given as DataFrames."""
        given = {name: (lambda df=df: df) for name, df in frames.items()}
        return Model(self.spark, {**self._tables, **given}, None if "imtrn" in given else self._movements_of)

    @classmethod
    def from_tables(cls, spark: SparkSession, src: str | dict) -> Model:
        """ERP tables stored as parquet folders, or in a database."""
        return cls(spark, {n: (lambda n=n: read_table(spark, src, n)) for n in TABLES})

    @classmethod
    def from_star(cls, spark: SparkSession, folder: str) -> Model:
        star = Star(spark, folder)
        names = [n for n, member in vars(Star).items() if callable(member) and not n.startswith("_")]
        return cls(spark, {n: getattr(star, n) for n in names if n not in ("read", "imtrn_of")}, star.imtrn_of)
