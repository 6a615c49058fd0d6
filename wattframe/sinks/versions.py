"""Parquet tables whose versions are committed by a manifest.

``<root>/<table>/table_version=<n>/<partition>=<value>`` holds the partitions that version n wrote,
``<root>/manifest/<n>.json`` names for every partition of each table the version that holds it, and for every writer
the last batch it committed; tables of one root change together. Rows are written
first and the manifest is renamed into place last: until then readers see the version before, and a write that failed
leaves files nobody names. A merge reads and writes the partitions its rows touch and no others; the manifest grows
with the number of partitions (days), not with rows. One writer commits at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattframe.sinks.merge import upsert

VERSION = "table_version"
EMPTY = {"version": -1, "writers": {}, "folders": {}}


def _path(spark: SparkSession, *parts: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def manifest(spark: SparkSession, root: str) -> dict:
    """The newest committed manifest; the empty one where nothing is committed."""
    numbers = [int(n[:-5]) for n in _names(spark, f"{root}/manifest") if n.endswith(".json") and n[:-5].isdigit()]
    if not numbers:
        return dict(EMPTY)
    text = spark.read.text(f"{root}/manifest/{max(numbers)}.json", wholetext=True).first()[0]
    return json.loads(text)


def _publish(spark: SparkSession, root: str, state: dict) -> None:
    target, fs = _path(spark, root, "manifest", f"{state['version']}.json")
    draft, _ = _path(spark, root, "manifest", f"{state['version']}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if not fs.rename(draft, target):
        raise RuntimeError(f"version {state['version']} of {root} was committed by another writer")


def read_table(spark: SparkSession, root: str, schema: StructType, table: str = "data", state: dict | None = None) -> DataFrame:
    """Rows of the newest committed version (or of the manifest given); no rows where none is."""
    if VERSION in (c.lower() for c in schema.names):
        raise ValueError(f"a column {VERSION} would clash with the folders of the versions")
    folders = (state or manifest(spark, root))["folders"].get(table, {})
    if not folders:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/{table}/{VERSION}={version}/{name}" for name, version in sorted(folders.items())]
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths).select(*schema.names)


def commit_tables(tables: dict[str, DataFrame], spark: SparkSession, root: str, partition: str, writer: str, batch_id: int) -> bool:
    """Replace the partitions that each frame holds in its table, all at once.

    False, and nothing done, where the writer committed this batch before.
    """
    state = manifest(spark, root)
    if state["writers"].get(writer, -1) >= batch_id:
        return False
    version = state["version"] + 1
    folders = dict(state["folders"])
    for table, df in tables.items():
        folder = f"{root}/{table}/{VERSION}={version}"
        df.write.mode("overwrite").partitionBy(partition).parquet(folder)
        folders[table] = folders.get(table, {}) | {n: version for n in _names(spark, folder) if "=" in n}
    _publish(spark, root, {"version": version, "writers": state["writers"] | {writer: batch_id}, "folders": folders})
    return True


def commit(df: DataFrame, root: str, partition: str, writer: str, batch_id: int) -> bool:
    """``commit_tables`` of one table."""
    return commit_tables({"data": df}, df.sparkSession, root, partition, writer, batch_id)


def merge_newest(new: DataFrame, root: str, schema: StructType, keys: Sequence[str], set_cols: Sequence[str], partition: str, revision: str, writer: str, batch_id: int, **options) -> bool:
    """Upsert rows whose revision is not below the stored one, as one commit.

    ``new`` holds one row per key, ``partition`` is one of the keys. A batch id that the writer committed before changes
    nothing.
    """
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")
    spark = new.sparkSession
    state = manifest(spark, root)
    if state["writers"].get(writer, -1) >= batch_id:
        return False
    # As many values as folders are rewritten; as literals they prune the scan to those folders.
    touched = [r[0] for r in new.select(partition).distinct().collect()]
    listed = F.col(partition).isin([v for v in touched if v is not None])
    if None in touched:
        listed = listed | F.col(partition).isNull()
    stored = read_table(spark, root, schema, state=state).filter(listed)
    merged = upsert(stored, new, keys, set_cols, newest_by=revision, **options)
    return commit(merged, root, partition, writer, batch_id)
