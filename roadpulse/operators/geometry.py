"""Corridor geometry as table jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.geo import along, bearing_deg, haversine_km
from roadpulse.functions.numeric import round_exact, steady_avg
from roadpulse.settings import DEFAULTS, Thresholds


def _ends() -> tuple[Column, Column, Column, Column]:
    return F.col("start_lat"), F.col("start_lon"), F.col("end_lat"), F.col("end_lon")


def _with_heading(corridors: DataFrame, *columns: str | Column) -> DataFrame:
    """The given columns and the heading in degrees, one decimal."""
    measured = corridors.select(*columns, bearing_deg(*_ends()).alias("bearing"))
    return measured.withColumn("heading", round_exact("bearing", 1)).drop("bearing")


def corridor_geometry(corridors: DataFrame) -> DataFrame:
    """Straight length in km and heading in degrees per corridor."""
    return _with_heading(corridors, "corridor_id", haversine_km(*_ends()).alias("length_km"))


def ping_positions(pings: DataFrame, corridors: DataFrame) -> DataFrame:
    """Place every ping along its corridor from its ``progress`` (0 to 1).

    The trigonometry runs once per corridor, on the small side of the join.
    """
    places = _with_heading(
        corridors, "corridor_id", "start_lat", "start_lon", "end_lat", "end_lon"
    )
    placed = pings.join(places, "corridor_id").select(
        *pings.columns,
        "heading",
        along(F.col("start_lat"), F.col("end_lat"), F.col("progress")).alias("raw_lat"),
        along(F.col("start_lon"), F.col("end_lon"), F.col("progress")).alias("raw_lon"),
        (F.col("progress") * 100).alias("raw_pct"),
    )
    return placed.select(
        *pings.columns,
        "heading",
        round_exact("raw_lat", 6).alias("latitude"),
        round_exact("raw_lon", 6).alias("longitude"),
        round_exact("raw_pct", 1).alias("progress_pct"),
    )


def map_extent(corridors: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Centre of all end points, and their bounds with a margin, in one pass."""
    points = corridors.select(
        F.inline(
            F.array(
                F.struct(F.col("start_lat").alias("lat"), F.col("start_lon").alias("lon")),
                F.struct(F.col("end_lat").alias("lat"), F.col("end_lon").alias("lon")),
            )
        )
    )
    pad = F.lit(th.map_padding_deg)
    return points.agg(
        steady_avg("lat").alias("center_lat"),
        steady_avg("lon").alias("center_lon"),
        (F.min("lat") - pad).alias("south"),
        (F.min("lon") - pad).alias("west"),
        (F.max("lat") + pad).alias("north"),
        (F.max("lon") + pad).alias("east"),
    )
