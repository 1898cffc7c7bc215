"""Traffic observations and their tumbling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.numeric import round_exact, steady_avg
from roadpulse.settings import DEFAULTS, Thresholds


def derive_traffic_metrics(observations: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Add index, speed, distance and event flag to travel time, free flow and length.

    The index never falls below zero; the flag looks at the unrounded index. A zero time
    gives nulls.
    """
    travel, free = F.col("travel_time_sec"), F.col("free_flow_sec")
    raw = observations.select(
        "*",
        F.greatest(F.lit(0.0), F.try_divide(travel - free, free)).alias("raw_index"),
        F.try_divide(F.col("length_m") / 1000, travel / 3600).alias("raw_speed"),
        (F.col("length_m") / 1000).alias("raw_distance"),
    )
    has_index = free != 0
    return raw.select(
        *observations.columns,
        F.when(has_index, round_exact("raw_index", 2)).alias("congestion_index"),
        round_exact("raw_speed", 1).alias("speed_kmh"),
        round_exact("raw_distance", 1).alias("distance_km"),
        F.when(has_index, F.col("raw_index") > th.event_index).alias("is_anomaly"),
    )


def flag_congestion(index: Column, speed: Column, th: Thresholds = DEFAULTS) -> Column:
    """True above the index limit or below the speed limit; nulls alone never flag."""
    return F.coalesce(
        (index > th.congestion_index) | (speed < th.congested_speed_kmh), F.lit(False)
    )


def traffic_windows(events: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Congestion metric rows: mean index and speed per corridor and window.

    Works on batches and streams. Rows without corridor or time are dropped. The window's end
    is the event time, and the travel columns stay zero.
    """
    windows = (
        events.where(F.col("corridor_id").isNotNull() & F.col("event_time").isNotNull())
        .groupBy("corridor_id", F.window("event_time", th.traffic_window))
        .agg(
            steady_avg("congestion_index").alias("congestion_index"),
            steady_avg("speed_kmh").alias("speed_kmh"),
        )
    )
    return windows.select(
        "corridor_id",
        F.col("window.end").alias("event_time"),
        F.lit(0).alias("travel_time_sec"),
        F.lit(0).alias("free_flow_sec"),
        "congestion_index",
        "speed_kmh",
        flag_congestion(F.col("congestion_index"), F.col("speed_kmh"), th).alias("is_anomaly"),
    )
