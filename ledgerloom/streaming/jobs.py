"""The polling habits of the reports as Structured Streaming jobs.

The running balance appends the rows that a micro-batch changed to a log
folder, one subfolder per batch.  A batch that is replayed after a failure
overwrites its own subfolder, so each change counts once.  Every ``COMPACT``-th
batch also writes the whole state, so a reader takes the last whole state and
the few batches after it.  Jobs that compare with what was before keep their
state by key (``streaming.keyed``): a batch opens the buckets of its own keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.columns import newest, signed_qty
from ledgerloom.operators.stock import KEY
from ledgerloom.schemas import TABLES, WEB_ORDER
from ledgerloom.session import SETTINGS
from ledgerloom.streaming.keyed import ARCHIVE, LIVE, MOST_PARTS, KeyedState

#: Where a change landed: file time, file name and place in the file.
LANDED = "landed struct<at: timestamp, file: string, row: bigint>"
ORDER_STATE = "id bigint, date_modified string, status string, date_created string, total string, " + LANDED + ", batch bigint"
CHANGE_STATE = "zid int, xitem string, inventory decimal(38,2), previous decimal(38,2), batch bigint"
BALANCE_STATE = "zid int, xitem string, inventory decimal(38,2), previous decimal(38,2)"
COMPACT = 20


class Log:
    """Batches of changed rows and, every ``every`` batches, the whole state.

    ``latest`` reduces rows with a column ``batch`` to the state; batch -1 is
    the state before the first batch.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, latest: Callable[[DataFrame], DataFrame],
                 every: int = COMPACT) -> None:
        self.spark, self.folder, self.schema, self.latest, self.every = spark, folder, schema, latest, every

    def open(self, state: DataFrame | None = None) -> None:
        """State before the first batch; a restarted job keeps what is there."""
        first = state if state is not None else self.spark.createDataFrame([], self.schema)
        first.select(*self._columns()).write.mode("ignore").parquet(f"{self.folder}/whole/batch=-1")

    def write(self, rows: DataFrame, batch: int) -> None:
        rows.select(*self._columns()).write.mode("overwrite").parquet(f"{self.folder}/changes/batch={batch}")
        if (batch + 1) % self.every == 0:
            self.state(batch).select(*self._columns()).write.mode("overwrite").parquet(f"{self.folder}/whole/batch={batch}")

    def batch(self, batch: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/changes/batch={batch}")

    def state(self, upto: int) -> DataFrame:
        """State after batch ``upto``: the last whole state before it and the batches since."""
        whole = upto // self.every * self.every - 1 if upto >= 0 else -1
        parts = [f"{self.folder}/whole/batch={whole}", *(f"{self.folder}/changes/batch={b}" for b in range(whole + 1, upto + 1))]
        # All parts in one scan; the last folder of a file's path tells its batch.
        rows = self.spark.read.schema(self.schema).parquet(*parts)
        batch = F.regexp_extract(F.col("_metadata.file_path"), r"batch=(-?\d+)/[^/]*$", 1).cast("bigint")
        return self.latest(rows.withColumn("batch", batch))

    def _columns(self) -> list[str]:
        return [f.name for f in self.spark.createDataFrame([], self.schema).schema]


def _run(stream: DataFrame, log: Log, each: Callable[[DataFrame, int], DataFrame], checkpoint: str,
         mode: str = "append") -> StreamingQuery:
    return (stream.writeStream.outputMode(mode)
            .foreachBatch(lambda rows, batch: log.write(each(rows, batch), batch))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last batch that a finished job has committed; -1 before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return -1
    names = [f.getPath().getName() for f in files.listStatus(path)]
    return max((int(n) for n in names if n.isdigit()), default=-1)


# --- orders -----------------------------------------------------------------------

def page_stream(spark: SparkSession, pages: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed order pages with the file each change came in."""
    reader = spark.readStream.schema(WEB_ORDER)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(pages).select(
        "id", "date_modified", "status", "date_created", "total",
        F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_name").alias("file"),
                 F.lit(None).cast("bigint").alias("row")).alias("landed"))


def latest_orders(changes: DataFrame) -> DataFrame:
    """Latest state per order: the newest change, of equally new ones the one that landed last."""
    fields = ["date_modified", "status", "date_created", "total", "landed", "batch"]
    return (changes.groupBy("id").agg(newest(["date_modified", "batch", "landed"], fields).alias("o"))
            .select("id", *[f"o.{c}" for c in fields]))


#: An order of these states is over, though a late change may still come.
CLOSED = ("completed", "order-cancelled")
#: Days after its last change that a closed order stays live, and the days between two looks at a bucket.
STAY_DAYS, SWEEP_DAYS = 30, 7


class OrderState(KeyedState):
    """Latest state of every order: open ones live, closed ones in the archive once their time is up.

    Time is that of the newest change seen.  A closed order is due ``stay``
    days after its last change, rounded up to whole ``sweep`` days, so that an
    untouched bucket is opened once a sweep at most.  The manifest notes when
    the first order of each bucket is due.  Archived files are only added to; an
    order that changes again comes back to life from its bucket of the archive.
    """

    def __init__(self, spark: SparkSession, folder: str, stay: int = STAY_DAYS, sweep: int = SWEEP_DAYS, **layout) -> None:
        super().__init__(spark, folder, ORDER_STATE, ["id"], **layout)
        self.stay, self.sweep = stay, sweep

    def due(self) -> Column:
        """Day from 1970 on which a closed order leaves; NULL while it is open or its date cannot be read."""
        changed = F.unix_date(F.substring("date_modified", 1, 10).try_cast("date"))
        return F.when(F.col("status").isin(*CLOSED), F.ceil((changed + self.stay) / self.sweep) * self.sweep).cast("long")

    def apply(self, rows: DataFrame, batch: int) -> None:
        """Bring the state up to date with the changes of one batch."""
        place = F.coalesce("landed.row", F.monotonically_increasing_id())
        news = rows.withColumns({
            "landed": F.struct(F.col("landed.at"), F.col("landed.file"), place.alias("row")),
            "batch": F.lit(batch).cast("bigint")})
        found = self.manifest(batch - 1)
        notes, filed = found["notes"], found["areas"].get(ARCHIVE, {})
        day = F.max(F.unix_date(F.substring("date_modified", 1, 10).try_cast("date")))
        met = {r.bucket: r.day for r in rows.groupBy(self.bucket().alias("bucket")).agg(day.alias("day")).collect()}
        now = max([d for d in met.values() if d is not None] + [notes.get("now", 0)])
        due = {int(k) for k, first in notes.get("due", {}).items() if first <= now}
        opened = sorted(set(met) | due)
        known = self.read(batch - 1, LIVE, opened)
        every = known.unionByName(news)
        if set(met) & set(filed):  # an order that is not live may have been filed
            strangers = rows.select("id").distinct().join(known.select("id"), "id", "left_anti")
            asked = {r.bucket for r in strangers.select(self.bucket().alias("bucket")).distinct().collect()}
            every = every.unionByName(self.read(batch - 1, ARCHIVE, asked).join(strangers, "id", "left_semi"))
        over = F.coalesce(self.due() <= now, F.lit(False))
        merged = latest_orders(every).withColumn("area", F.when(over, ARCHIVE).otherwise(LIVE))
        crowded = [k for k, parts in filed.items() if len(parts) >= MOST_PARTS]
        self.write(batch, merged, opened)
        first = self.changed(batch).withColumn("due", self.due()).where("due IS NOT NULL").groupBy(
            self.bucket().alias("bucket")).agg(F.min("due").alias("due"))
        dues = {int(k): d for k, d in notes.get("due", {}).items() if int(k) not in opened} | {r.bucket: r.due for r in first.collect()}
        areas = self.manifest(batch)["areas"]
        self._write_manifest(batch, areas, {"now": now, "due": dues})
        if crowded:
            self._put_together(batch, crowded)

    def _put_together(self, batch: int, buckets: list[int]) -> None:
        """Files of crowded buckets of the archive become one each, under a number of their own beside the batch."""
        found = self.manifest(batch)
        own = -2 - batch  # never the number of a batch
        rows = latest_orders(self.read(batch, ARCHIVE, buckets)).withColumn("area", F.lit(ARCHIVE))
        for k in self._write_rows(own, rows).get(ARCHIVE, []):
            found["areas"][ARCHIVE][k] = [own]
        self._write_manifest(batch, found["areas"], found["notes"])

    def state(self, upto: int) -> DataFrame:
        """Latest state of every order, live or archived; an order that came back is in both, the newer row counts."""
        return latest_orders(self.read(upto, LIVE).unionByName(self.read(upto, ARCHIVE)))


def stream_order_status(changes: DataFrame, state: OrderState, checkpoint: str) -> StreamingQuery:
    """Keep the latest state of every order from a stream of changes (see ``page_stream``).

    The newest change wins whatever the order of arrival, and a repeated page
    changes nothing, so no page is ever too late and none is dropped.
    """
    state.open()
    return (changes.writeStream.foreachBatch(state.apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# --- stock ------------------------------------------------------------------------

def running_balances(moves: DataFrame) -> DataFrame:
    """Running stock per (unit, item); one state row per key, bounded by the catalog."""
    return moves.groupBy(*KEY).agg(F.sum(signed_qty()).cast("decimal(38,2)").alias("inventory"))


def latest_balances(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.max(F.struct("batch", "inventory", "previous")).alias("b")).select(
        *KEY, "b.inventory", "b.previous")


def balance_log(spark: SparkSession, folder: str, every: int = COMPACT) -> Log:
    return Log(spark, folder, BALANCE_STATE, latest_balances, every)


def movement_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(TABLES["imtrn"])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_stock_balance(moves: DataFrame, log: Log, checkpoint: str) -> StreamingQuery:
    """Log the new balance of every item that a batch of movements touched.

    The state has a row per item of every unit, too many for a heap; it is kept
    in RocksDB also where the caller's session says nothing about it.
    """
    log.open()
    provider = "spark.sql.streaming.stateStore.providerClass"
    log.spark.conf.set(provider, SETTINGS[provider])
    return _run(running_balances(moves), log,
                lambda rows, batch: rows.withColumn("previous", F.lit(None).cast("decimal(38,2)")), checkpoint, "update")


class BalanceState(KeyedState):
    """Balance of every item, with the one before and the batch of its last change."""

    def __init__(self, spark: SparkSession, folder: str, **layout) -> None:
        super().__init__(spark, folder, CHANGE_STATE, KEY, **layout)

    def start(self, balances: DataFrame | None) -> None:
        self.open(None if balances is None else balances.withColumns(
            {"previous": F.lit(None).cast("decimal(38,2)"), "batch": F.lit(-1).cast("bigint")}))

    def apply(self, rows: DataFrame, batch: int) -> None:
        """Add the movements of one batch to the balances of its own buckets."""
        change = running_balances(rows).withColumnRenamed("inventory", "change").persist()
        met = [r.bucket for r in change.select(self.bucket().alias("bucket")).distinct().collect()]
        before = self.read(batch - 1, LIVE, met)
        moved = F.col("change").isNotNull()
        zero = F.lit(0).cast("decimal(38,2)")
        after = before.join(change, KEY, "full").select(
            *KEY, (F.coalesce("inventory", zero) + F.coalesce("change", zero)).cast("decimal(38,2)").alias("inventory"),
            F.when(moved, F.col("inventory")).otherwise(F.col("previous")).alias("previous"),
            F.when(moved, F.lit(batch)).otherwise(F.col("batch")).cast("bigint").alias("batch"), F.lit(LIVE).alias("area"))
        self.write(batch, after, met)
        change.unpersist()

    def batch(self, batch: int) -> DataFrame:
        """Items that a batch moved, with the balance before it; NULL for an item that had none."""
        return self.changed(batch).where(F.col("batch") == batch).select(*KEY, "inventory", "previous")

    def state(self, upto: int) -> DataFrame:
        return self.read(upto)


def stream_stock_changes(moves: DataFrame, state: BalanceState, checkpoint: str, start: DataFrame | None = None) -> StreamingQuery:
    """Keep the new and the previous balance of every item that a batch of movements touched.

    ``start`` has the balances (zid, xitem, inventory) before the stream.  The
    batch is summed first and meets the buckets of its own items only.
    """
    state.start(start)
    return (moves.writeStream.foreachBatch(state.apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def changed_since(state: BalanceState, upto: int) -> DataFrame:
    """Items whose balance after batch ``upto`` differs from the one before the first batch.

    Only buckets that have been written since are compared.
    """
    touched = [k for k, parts in state.manifest(upto)["areas"].get(LIVE, {}).items() if parts != [-1]]
    before = state.read(-1, LIVE, touched).select(*KEY, F.col("inventory").alias("previous"))
    now = state.read(upto, LIVE, touched).select(*KEY, "inventory")
    return now.join(before, KEY, "left").where("previous IS NULL OR previous <> inventory")
