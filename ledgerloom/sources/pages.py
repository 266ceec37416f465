"""Landed pages of web documents as a Spark data source, batch and stream.

A landing writes pages of JSON documents, one file each, in the order of a
date field, and then an index that tells the first and last date of every page.
A reader makes one partition of a page.  A cut-off on the date field is pushed
down and leaves pages out by the index, unopened.  A stream's offset is the
number of landings; a landing shows once its index is complete, so it is read
whole or not at all, and a replayed batch reads the same pages.

The folder has to be one that Python on the executors can open (a shared mount,
or a store that Arrow knows by its scheme).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.json as pajson
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerloom.schemas import WEB_ORDER, WEB_PRODUCT
from ledgerloom.sources.shared import ship_package

FORMAT = "landed_pages"
KINDS = {"order": WEB_ORDER, "product": WEB_PRODUCT}
#: Documents a page holds, as the shop's interface sends them.
PAGE = 100
INDEX = "page string, n bigint, first string, last string"


# --- landing

def land_pages(docs: DataFrame, folder: str, landing: int, date: str = "date_created", per_page: int = PAGE) -> None:
    """Write documents as pages of at most ``per_page``, ordered by ``date``, and their index last.

    A landing that is run again replaces its own pages and index.
    """
    spark = docs.sparkSession
    target = f"{folder}/pages/landing={landing}"
    ordered = docs if date not in docs.columns else docs.repartitionByRange(date).sortWithinPartitions(date)
    ordered.write.mode("overwrite").option("maxRecordsPerFile", per_page).json(target)
    when = F.get_json_object("value", f"$.{date}")
    # Every document counts, also one that no reader can make sense of.
    listed = spark.read.text(target).groupBy(F.col("_metadata.file_name").alias("page")).agg(
        F.count(F.lit(1)).alias("n"), F.min(when).alias("first"), F.max(when).alias("last"))
    listed.selectExpr("page", "n", "first", "last").coalesce(1).write.mode("overwrite").parquet(f"{folder}/index/landing={landing}")


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def landings(folder: str) -> int:
    """Number of complete landings, counted from 0 without a gap."""
    files, root = _open(folder)
    done = 0
    while files.get_file_info(f"{root}/index/landing={done}/_SUCCESS").type == pafs.FileType.File:
        done += 1
    return done


@dataclass
class Page(InputPartition):
    """One page, told by its place in the folder."""

    path: str

    def __init__(self, path: str) -> None:
        self.path = path
        self.value = path


@dataclass(frozen=True)
class Range:
    """Dates a page must reach to be read; None is no bound."""

    low: str | None = None
    high: str | None = None

    def within(self, test: Filter, date: str) -> Range:
        """This range cut by a pushed filter; other filters leave it as it is."""
        if getattr(test, "attribute", None) != (date,) or not isinstance(getattr(test, "value", None), str):
            return self
        low = test.value if isinstance(test, (GreaterThan, GreaterThanOrEqual, EqualTo)) else None
        high = test.value if isinstance(test, (LessThan, LessThanOrEqual, EqualTo)) else None
        return Range(max(filter(None, (self.low, low)), default=None), min(filter(None, (self.high, high)), default=None))


def pages_of(folder: str, first: int, until: int, bounds: Range) -> list[str]:
    """Pages of the landings ``first`` to ``until`` - 1 that reach into the bounds, by the index alone.

    A page without any date has no document that a bound could keep.
    """
    files, root = _open(folder)
    found = []
    for landing in range(first, until):
        index = ds.dataset(f"{root}/index/landing={landing}", filesystem=files, format="parquet")
        keep = None
        for column, bound, holds in (("last", bounds.low, pc.greater_equal), ("first", bounds.high, pc.less_equal)):
            if bound is not None:
                test = holds(ds.field(column), pa.scalar(bound))
                keep = test if keep is None else keep & test
        pages = index.to_table(columns=["page"], filter=keep).column("page").to_pylist()
        found += [f"pages/landing={landing}/{page}" for page in sorted(pages)]
    return found


# --- reading a page

def _fit(value, kind: pa.DataType):
    """A JSON value in the type of its field; what does not fit is missing."""
    if value is None:
        return None
    if pa.types.is_string(kind):
        return value if isinstance(value, str) else json.dumps(value)
    if pa.types.is_integer(kind):
        try:
            return int(value)
        except (TypeError, ValueError):
            return None
    if pa.types.is_list(kind):
        return [_fit(v, kind.value_type) for v in value] if isinstance(value, list) else None
    if pa.types.is_struct(kind):
        return {f.name: _fit(value.get(f.name), f.type) for f in kind} if isinstance(value, dict) else None
    return value


def _parse(line: str) -> dict:
    try:
        document = json.loads(line)
    except ValueError:
        return {}
    return document if isinstance(document, dict) else {}


def documents(content: bytes, schema: pa.Schema) -> pa.Table:
    """The documents of a page, one JSON object a line; unknown fields go.

    A page of the expected types is read in one go, any other document by
    document: a value of another type is shown as text or missing, and a line
    that is no object gives a document without values.
    """
    try:
        options = pajson.ParseOptions(explicit_schema=schema, unexpected_field_behavior="ignore")
        return pajson.read_json(pa.BufferReader(content), parse_options=options).select(schema.names).cast(schema)
    except (pa.ArrowInvalid, pa.ArrowKeyError, KeyError):
        lines = [line for line in content.decode("utf-8", "replace").split("\n") if line.strip()]
        whole = pa.struct(list(schema))
        return pa.Table.from_struct_array(pa.array([_fit(_parse(line), whole) for line in lines], whole)).cast(schema)


def _read(folder: str, schema: pa.Schema, page: Page) -> Iterator[pa.RecordBatch]:
    files, root = _open(folder)
    with files.open_input_stream(f"{root}/{page.path}") as stream:
        yield from documents(stream.read(), schema).to_batches()


class LandedPages(DataSource):
    """Options: ``path`` the folder, ``kind`` order or product, ``date`` the field the index tells, ``after`` a stream's cut-off."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return KINDS[self.options.get("kind", "order")]

    def reader(self, schema: StructType) -> DataSourceReader:
        return PageReader(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return PageStreamReader(self.options, schema)


class PageReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.folder, self.date = options["path"], options.get("date", "date_created")
        self.arrow = to_arrow_schema(schema)
        self.bounds = Range(options.get("after"))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on the date leave pages out; all are tested on the documents again."""
        for test in filters:
            self.bounds = self.bounds.within(test, self.date)
            yield test

    def partitions(self) -> list[Page]:
        return [Page(p) for p in pages_of(self.folder, 0, landings(self.folder), self.bounds)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        if partition is not None and partition.path is not None:
            yield from _read(self.folder, self.arrow, partition)


class PageStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.folder = options["path"]
        self.arrow = to_arrow_schema(schema)
        self.bounds = Range(options.get("after"))

    def initialOffset(self) -> dict:
        return {"landings": 0}

    def latestOffset(self) -> dict:
        return {"landings": landings(self.folder)}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        return [Page(p) for p in pages_of(self.folder, start["landings"], end["landings"], self.bounds)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        yield from _read(self.folder, self.arrow, partition)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedPages)


def read_pages(spark: SparkSession, folder: str, kind: str = "order", after: str | None = None, date: str = "date_created") -> DataFrame:
    """Documents of all landed pages, or those whose ``date`` is at least ``after``."""
    register(spark)
    docs = spark.read.format(FORMAT).option("kind", kind).option("date", date).load(folder)
    return docs if after is None else docs.where(F.col(date) >= after)


def stream_pages(spark: SparkSession, folder: str, kind: str = "order", after: str | None = None, date: str = "date_created") -> DataFrame:
    """The same documents as a stream, a batch for what has landed since the last one."""
    register(spark)
    reader = spark.readStream.format(FORMAT).option("kind", kind)
    if after is None:
        return reader.load(folder)
    return reader.option("after", after).load(folder).where(F.col(date) >= after)
