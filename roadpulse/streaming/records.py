"""Small records about batches: one JSON file each, packed into Parquet now and then.

The driver writes a record without a Spark job, and a record written again under its name
replaces itself. Packing leaves what a folder says unchanged: records come out once however
often they are stored, the newest of a name if they differ.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roadpulse.operators.latest import latest_by
from roadpulse.streaming import files

# Orders records of one name: the later write wins.
_WRITTEN = T.StructField("recorded_at", T.TimestampType())


def write(spark: SparkSession, folder: str, name: str, record: dict, at) -> None:
    """Store a record under its name; ``at`` is the moment of writing."""
    text = json.dumps({**record, "name": name, "recorded_at": at.isoformat()}, default=str)
    files.write_text(spark, f"{folder}/{name}.json", text + "\n")


def _all(
    spark: SparkSession, folder: str, schema: T.StructType, above: str | None = None
) -> DataFrame | None:
    stored = T.StructType([*schema.fields, T.StructField("name", T.StringType()), _WRITTEN])
    singles, packs = [], []
    for found in files.children(spark, folder):
        # a pack is named after the last record it holds
        name = found.removesuffix(".json").removeprefix("pack-")
        if found.startswith("_") or (above is not None and name <= above):
            continue
        if found.endswith(".json"):
            singles.append(f"{folder}/{found}")
        elif files.exists(spark, f"{folder}/{found}/_SUCCESS"):
            packs.append(f"{folder}/{found}")
    frames = []
    if singles:
        frames.append(spark.read.schema(stored).json(singles))
    if packs:
        frames.append(spark.read.schema(stored).parquet(*packs))
    if not frames:
        return None
    if not packs:
        return frames[0]
    everything = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    if above is not None:
        everything = everything.where(everything["name"] > above)
    return latest_by(everything, ["name"], ["recorded_at"])


def read(
    spark: SparkSession, folder: str, schema: T.StructType, above: str | None = None
) -> DataFrame:
    """One row per record name, of names after ``above`` only; an absent folder is empty."""
    found = _all(spark, folder, schema, above)
    return spark.createDataFrame([], schema) if found is None else found.select(*schema.names)


def pack(spark: SparkSession, folder: str, schema: T.StructType) -> int:
    """Put all records into one Parquet folder; returns how many single files that took.

    The records and packs it has read are removed once the new pack is complete; until then
    both are there and say the same.
    """
    before = [n for n in files.children(spark, folder) if n.endswith(".json") or n.startswith("pack-")]
    singles = [n for n in before if n.endswith(".json") and not n.startswith("_")]
    if not singles:
        return 0
    last = max(n.removesuffix(".json").removeprefix("pack-") for n in before)
    last = last.split("~")[0] + "~" + uuid.uuid4().hex
    _all(spark, folder, schema).coalesce(1).write.parquet(f"{folder}/pack-{last}")
    for name in before:
        files.delete(spark, f"{folder}/{name}")
    return len(singles)
