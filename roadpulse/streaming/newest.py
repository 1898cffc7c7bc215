"""The newest row of every entity, kept beside a log as one small table.

Every version of the table is a snapshot made from the one before and the log's rows since, so
a batch costs its own rows and one row per entity, whatever the log's age. A replayed batch
starts again from the snapshot below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roadpulse.operators.latest import latest_by
from roadpulse.streaming import files


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Complete snapshots, oldest first."""
    found = files.children(spark, folder, "snapshot=")
    return sorted(int(n.split("=")[1]) for n in found if files.exists(spark, f"{folder}/{n}/_SUCCESS"))


def read(spark: SparkSession, folder: str, schema: T.StructType, below: int | None = None) -> DataFrame | None:
    """The newest snapshot, or the newest below a version; none if there is none."""
    found = [v for v in versions(spark, folder) if below is None or v < below]
    return spark.read.schema(schema).parquet(f"{folder}/snapshot={found[-1]}") if found else None


def merge(folder: str, changed: DataFrame, keys: list[str], order: list[str], version: int) -> None:
    """Merge changed rows over the snapshot below ``version`` and write that version.

    ``order`` decides which row of a key is newest. Snapshots older than the one merged over are
    removed; whoever reads that one is not disturbed.
    """
    spark = changed.sparkSession
    base = read(spark, folder, changed.schema, version)
    rows = changed if base is None else base.unionByName(changed)
    latest_by(rows, keys, order).write.mode("overwrite").parquet(f"{folder}/snapshot={version}")
    for old in [v for v in versions(spark, folder) if v < version][:-1]:
        files.delete(spark, f"{folder}/snapshot={old}")

