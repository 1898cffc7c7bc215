"""Small fixed lookup tables, and the corridor list.

The fixed tables are local relations: the planner knows their exact size and broadcasts them
by its own threshold. Nothing in this package forces a broadcast, so a lookup that grows past
``spark.sql.autoBroadcastJoinThreshold`` is shuffled instead.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import settings


def _local(spark: SparkSession, rows, columns: list[tuple[str, pa.DataType]]) -> DataFrame:
    arrays = [
        pa.array([row[i] for row in rows], type=kind) for i, (_, kind) in enumerate(columns)
    ]
    return spark.createDataFrame(pa.table(arrays, names=[name for name, _ in columns]))


def monitored_corridors(spark: SparkSession) -> DataFrame:
    """The fixed corridors with their road lengths."""
    return _local(
        spark,
        settings.CORRIDORS,
        [
            ("corridor_id", pa.string()),
            ("name", pa.string()),
            ("city", pa.string()),
            ("start_lat", pa.float64()),
            ("start_lon", pa.float64()),
            ("end_lat", pa.float64()),
            ("end_lon", pa.float64()),
            ("distance_km", pa.float64()),
        ],
    )


def weather_locations(spark: SparkSession) -> DataFrame:
    return _local(
        spark,
        settings.WEATHER_LOCATIONS,
        [("location", pa.string()), ("latitude", pa.float64()), ("longitude", pa.float64())],
    )


def weather_codes(spark: SparkSession) -> DataFrame:
    return _local(
        spark,
        settings.WEATHER_CODES,
        [("weather_code", pa.int32()), ("description", pa.string()), ("icon", pa.string())],
    )


def topic_names(spark: SparkSession, expected: list[str], existing: list[str]) -> DataFrame:
    """Expected topics, each marked whether the broker knows it."""
    return _local(
        spark,
        [(name, name in set(existing)) for name in expected],
        [("topic", pa.string()), ("topic_exists", pa.bool_())],
    )


def load_corridors(listing: DataFrame, *extra: Column) -> DataFrame:
    """Corridor rows from a listing of ``id, name, city, start{lat,lon}, end{lat,lon}``.

    A missing name becomes the id and a missing city the default city. ``extra`` columns are
    taken along.
    """
    return listing.select(
        F.col("id").alias("corridor_id"),
        F.coalesce("name", "id").alias("name"),
        F.coalesce("city", F.lit(settings.DEFAULT_CITY)).alias("city"),
        F.col("start.lat").alias("start_lat"),
        F.col("start.lon").alias("start_lon"),
        F.col("end.lat").alias("end_lat"),
        F.col("end.lon").alias("end_lon"),
        *extra,
    )
