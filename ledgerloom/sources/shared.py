"""The folder every executor can reach."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would vanish with its executor.
    """
    folder = spark.conf.get(CONF, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set(CONF, folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written_once(df: DataFrame) -> DataFrame:
    """``df`` as rows in the shared folder, worked out once, however often it is read from here on."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the session was started from."""
    context = spark.sparkContext
    if getattr(context, "_ledgerloom_package", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-code-"), "ledgerloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(archive)
    context._ledgerloom_package = True
