"""Session defaults and lineage cutting."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wattframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Only the time zone, adaptive execution and checkpoint cleaning are set here; cluster sizing stays with
    the submitter.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the one the session names in ``spark.checkpoint.dir``.

    A folder of our own is set only where the session has none and there is a single process, as in tests.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Written as Parquet to a folder of its own below the shared one, and read again."""
    folder = f"{shared_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that a job of ours wrote below the shared one."""
    if not folder.startswith(shared_folder(spark) + "/"):
        raise ValueError(f"{folder} is not below the shared folder")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
