"""Rows by key in a shared folder, so that a batch reads and writes its own keys only.

Keys are dealt into a fixed number of buckets by a hash.  A batch writes new
files for the buckets it touches and then a manifest that names, for every
bucket, the batches whose files make it up; files are never changed.  A batch
that is run again reads the manifest before it and writes the same files and
the same manifest once more, so nothing counts twice and a lost executor costs
its tasks only.  Rows live in areas (``live``, ``archive``): one area is replaced
bucket by bucket, another may be added to.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16
LIVE, ARCHIVE = "live", "archive"
#: Files of a bucket that may be added before they are put together.
MOST_PARTS = 20


class Files:
    """The few file operations a manifest needs, on whatever store Spark reaches."""

    def __init__(self, spark: SparkSession) -> None:
        self._conf, self._jvm = spark._jsc.hadoopConfiguration(), spark._jvm

    def _path(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        path, fs = self._path(folder)
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def write(self, path: str, text: str) -> None:
        """The whole text or nothing: written aside, then put in place."""
        aside, fs = self._path(f"{path}.aside")
        at, _ = self._path(path)
        out = fs.create(aside, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        fs.delete(at, False)
        if not fs.rename(aside, at):
            raise OSError(f"cannot write {path}")

    def read(self, path: str) -> str:
        at, fs = self._path(path)
        stream = fs.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files below a folder."""
        at, fs = self._path(path)
        return fs.getContentSummary(at).getLength()

    def exists(self, path: str) -> bool:
        at, fs = self._path(path)
        return fs.exists(at)

    def delete(self, path: str) -> None:
        at, fs = self._path(path)
        fs.delete(at, True)


class KeyedState:
    """State of a stream: ``schema`` rows under ``keys``, in ``buckets`` folders.

    The number of buckets is kept with the state; choose it so that a bucket
    stays small, because a batch rewrites the live rows of the buckets it touches.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: list[str], buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self.schema, self.keys, self.buckets = spark, folder, schema, keys, buckets
        self.files = Files(spark)

    # --- manifests

    def _manifest_path(self, batch: int) -> str:
        return f"{self.folder}/manifest/{batch}.json"

    def manifest(self, batch: int) -> dict:
        """What makes up the state after ``batch``: ``areas`` {area: {bucket: [batches]}}, ``notes`` of the job."""
        found = json.loads(self.files.read(self._manifest_path(batch)))
        self.buckets = found["buckets"]
        found["areas"] = {a: {int(k): v for k, v in held.items()} for a, held in found["areas"].items()}
        return found

    def _write_manifest(self, batch: int, areas: dict, notes: dict) -> None:
        self.files.write(self._manifest_path(batch), json.dumps({"buckets": self.buckets, "areas": areas, "notes": notes}))

    # --- rows

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def open(self, rows: DataFrame | None = None, notes: dict | None = None) -> None:
        """State before the first batch; a restarted job keeps what is there."""
        if self.files.exists(self._manifest_path(-1)):
            self.manifest(-1)
            return
        held = {} if rows is None else self._write_rows(-1, rows.withColumn("area", F.lit(LIVE)))
        self._write_manifest(-1, {a: {k: [-1] for k in ks} for a, ks in held.items()}, notes or {})

    def read(self, batch: int, area: str = LIVE, only: Iterable[int] | None = None) -> DataFrame:
        """Rows of an area after ``batch``; of the buckets ``only``, no other file is opened."""
        held = self.manifest(batch)["areas"].get(area, {})
        chosen = held if only is None else set(only) & set(held)
        return self._read([(part, area, k) for k in chosen for part in held[k]])

    def _read(self, parts: list[tuple[int, str, int]]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.folder}/rows/batch={batch}/area={area}/bucket={k}" for batch, area, k in sorted(parts)]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def changed(self, batch: int, area: str = LIVE) -> DataFrame:
        """Rows of the buckets that ``batch`` wrote."""
        held = self.manifest(batch)["areas"].get(area, {})
        return self._read([(batch, area, k) for k, parts in held.items() if batch in parts])

    def _write_rows(self, batch: int, rows: DataFrame) -> dict[str, list[int]]:
        """Write rows with a column ``area``; one file a bucket, sorted by key.  The buckets that came to be, by area."""
        target = f"{self.folder}/rows/batch={batch}"
        columns = [f.name for f in self.spark.createDataFrame([], self.schema).schema]
        (rows.withColumn("bucket", self.bucket()).select(*columns, "area", "bucket")
         .repartition("area", "bucket").sortWithinPartitions("area", "bucket", *self.keys)
         .write.mode("overwrite").partitionBy("area", "bucket").parquet(target))
        numbers = lambda names: [int(n.split("=")[1]) for n in names if n.startswith("bucket=")]
        return {a.split("=")[1]: numbers(self.files.names(f"{target}/{a}"))
                for a in self.files.names(target) if a.startswith("area=")}

    def write(self, batch: int, rows: DataFrame, replaced: Iterable[int], notes: dict | None = None) -> None:
        """State after ``batch``: ``rows`` replace the live rows of the buckets ``replaced``, and add to the archive."""
        before = self.manifest(batch - 1)
        written = self._write_rows(batch, rows)
        live = {k: v for k, v in before["areas"].get(LIVE, {}).items() if k not in set(replaced)}
        live |= {k: [batch] for k in written.get(LIVE, [])}
        archive = dict(before["areas"].get(ARCHIVE, {}))
        for k in written.get(ARCHIVE, []):
            archive[k] = [*archive.get(k, []), batch]
        self._write_manifest(batch, {LIVE: live, ARCHIVE: archive}, notes or {})

    def expire(self, batch: int) -> int:
        """Delete the files that no manifest from ``batch`` on needs; how many folders went.

        Call it for a batch that is committed and will not be run again.
        """
        kept = {int(n.removesuffix(".json")) for n in self.files.names(f"{self.folder}/manifest") if n.endswith(".json")}
        needed = {(part, a, k) for b in kept if b >= batch
                  for a, held in self.manifest(b)["areas"].items() for k, parts in held.items() for part in parts}
        gone = 0
        for b in sorted(b for b in kept if b < batch):
            if b >= 0:
                self.files.delete(self._manifest_path(b))
            for name in self.files.names(f"{self.folder}/rows/batch={b}"):
                area = name.split("=")[-1]
                for inner in self.files.names(f"{self.folder}/rows/batch={b}/{name}"):
                    if inner.startswith("bucket=") and (b, area, int(inner.split("=")[1])) not in needed and b >= 0:
                        self.files.delete(f"{self.folder}/rows/batch={b}/{name}/{inner}")
                        gone += 1
        return gone
