"""Session settings the operators are planned for."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution coalesces small shuffle partitions and splits the
    # partitions that a hot document, item or supplier makes too large.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the next step then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # Stock balances keep one state row per (unit, item): too many for the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    # Wide reports build hundreds of columns; a call site for each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Bytes of compressed rows that a task takes from a file or a shuffle.  Sums by item, sorts and joins hold
#: some ten times as much in memory, at any size of the tables.
TASK_BYTES = 16 << 20
#: Bytes of table files for each partition of a shuffle before small ones are put together.
SHUFFLE_BYTES = 4 << 20
TASKS = {
    "spark.sql.files.maxPartitionBytes": TASK_BYTES,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 4 * TASK_BYTES,
    # Every task holds a broadcast side whole.  A file's bytes tell little of it: items of 5 MB are 0.7 GB of
    # rows.  Larger sides are broadcast only by the bytes that adaptive execution has counted.
    "spark.sql.autoBroadcastJoinThreshold": 256 << 10,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": 10 << 20,
}
#: Folders a task writes side by side; only beyond that are its rows sorted by folder.
WRITERS, SIDE_BY_SIDE = "spark.sql.maxConcurrentOutputFileWriters", 4
PARTITIONS, INITIAL = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def sized_session(spark: SparkSession, table_bytes: int) -> SparkSession:
    """A session beside the caller's, with its settings, whose tasks stay small over tables of ``table_bytes``.

    A task's part must not grow with the tables: shuffles start with as many
    partitions as the bytes ask for, and small ones are put together up to
    ``TASK_BYTES``.  Smaller parts that the caller has set stay.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.get(key, None) != value:
            own.conf.set(key, value)
    for key, most in TASKS.items():
        set_by_caller = own.conf.get(key, None)
        own.conf.set(key, str(most if set_by_caller is None else min(most, size_of(set_by_caller))))
    own.conf.set(WRITERS, str(max(SIDE_BY_SIDE, int(own.conf.get(WRITERS, "0")))))
    asked = int(own.conf.get(INITIAL, None) or own.conf.get(PARTITIONS))
    own.conf.set(INITIAL, str(max(asked, -(-table_bytes // SHUFFLE_BYTES))))
    return own


def size_of(setting: str) -> int:
    """Bytes of a size setting such as 64MB, 128m or 1048576b."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def get_session(app: str = "ledgerloom", master: str | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
