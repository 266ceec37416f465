"""Sources. Every reader has an explicit schema, so none scans data to infer one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import (
    SHEET_HEADERS,
    SHEET_TYPES,
    STOCK_SNAPSHOT,
    TABLES,
    WEB_ORDER,
    WEB_PRODUCT,
)


PARTITION_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(src: dict, name: str) -> dict:
    """Options of the database reader for a table.

    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    are demanded: without them one task would read the whole table.
    """
    missing = [o for o in PARTITION_OPTIONS if o not in src]
    if missing:
        raise ValueError(f"give JDBC options {', '.join(missing)}; one task would read all of {name}")
    return {**{k: v for k, v in src.items() if k != "cuts"}, "dbtable": name}


def measured_cuts(df: DataFrame, key: str, parts: int) -> list:
    """Keys that part the rows of a copy of the table (the last load, a sample of it) evenly; at most ``parts`` - 1.

    A key that many rows have comes up once; its rows stay together.
    """
    points = [i / parts for i in range(1, parts)]
    found = df.where(F.col(key).isNotNull()).agg(F.percentile_approx(key, points, 100 * parts)).first()[0]
    return sorted(set(found or []))


def balanced_predicates(key: str, cuts: list) -> list[str]:
    """Conditions of one read each: no row meets two, every row meets one, rows without a key included."""
    if not cuts:
        return ["1 = 1"]
    shown = [repr(c) if isinstance(c, (int, float)) else "'" + str(c).replace("'", "''") + "'" for c in cuts]
    ranges = [f"{key} < {shown[0]} OR {key} IS NULL"]
    ranges += [f"{key} >= {low} AND {key} < {high}" for low, high in zip(shown, shown[1:])]
    return [*ranges, f"{key} >= {shown[-1]}"]


def read_table(spark: SparkSession, src: str | dict, name: str) -> DataFrame:
    """ERP table from a parquet folder, or from a database.

    ``src`` is a folder path, or JDBC options (see ``jdbc_options``).  ``cuts``
    among them, {table: (column, keys)} from ``measured_cuts``, reads a table
    whose keys are skewed or sparse in parts of even size instead of even
    bounds.  Filters and columns reach either source.
    """
    columns = [f.strip().split()[0] for f in _split(TABLES[name])]
    if not isinstance(src, dict):
        return spark.read.schema(TABLES[name]).parquet(f"{src}/{name}").select(*columns)
    if name in src.get("cuts", {}):
        column, keys = src["cuts"][name]
        properties = {k: str(v) for k, v in src.items() if k not in ("cuts", "url", *PARTITION_OPTIONS)}
        return spark.read.jdbc(src["url"], name, predicates=balanced_predicates(column, keys), properties=properties).select(*columns)
    return spark.read.format("jdbc").options(**jdbc_options(src, name)).load().select(*columns)


def _split(schema: str) -> list[str]:
    """Fields of a DDL string; a comma inside decimal(18,2) does not separate."""
    fields, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch in "(<") - (ch in ")>")
        if ch == "," and depth == 0:
            fields.append(schema[start:i])
            start = i + 1
    return [*fields, schema[start:]]


def read_catalog_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Catalog sheet saved as csv with display headers, renamed to codes."""
    schema = ", ".join(
        f"`{header}` {SHEET_TYPES.get(code, 'string')}" for header, code in SHEET_HEADERS.items()
    )
    return (spark.read.schema(schema).option("header", True).csv(path)
            .withColumnsRenamed(SHEET_HEADERS))


def read_web_orders(spark: SparkSession, path: str) -> DataFrame:
    """Landed order pages, one JSON document per line."""
    return spark.read.schema(WEB_ORDER).json(path)


def read_web_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WEB_PRODUCT).json(path)


def read_snapshot(spark: SparkSession, path: str, snapshot_date: str) -> DataFrame:
    """Stock snapshot of one day; only that day's partition is read."""
    return (spark.read.schema(STOCK_SNAPSHOT + ", snapshot_date date").parquet(path)
            .filter(F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))
            .drop("snapshot_date"))
