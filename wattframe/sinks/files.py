"""File writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def write_touched(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace the partitions present in the frame and leave the others alone."""
    df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)


def report_folder(root: str, name: str, date: str, revision: int) -> str:
    """Folder of one report; its name carries the delivery date and the revision."""
    return f"{root.rstrip('/')}/{name}_{date}_R{revision}"


def write_report(df: DataFrame, path: str, split_by: str, order: Sequence[str] = ()) -> None:
    """One folder of delimited files per value of ``split_by`` (the sheets of a report), headers on."""
    sheet = F.col(split_by)
    arranged = df.repartitionByRange(sheet, *order).sortWithinPartitions(split_by, *order) if order else df
    arranged.write.mode("overwrite").option("header", "true").partitionBy(split_by).csv(path)
