"""Weekday-by-hour baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.numeric import steady_avg, steady_avg_of_parts, steady_parts
from roadpulse.functions.times import before, instant
from roadpulse.operators.serving import scan_metrics
from roadpulse.settings import DEFAULTS, Thresholds

BASELINE_KEYS = ["corridor_id", "day_of_week", "hour_of_day"]
ESTIMATE = "(congestion_index + 1) * 60"
BASELINE_VALUES = ["avg_travel_time_sec", "sample_count", "updated_at"]


def baselines(
    metrics: DataFrame, corridors: DataFrame, as_of, th: Thresholds = DEFAULTS
) -> DataFrame:
    """Mean travel-time estimate per corridor, weekday (0 = Monday) and hour.

    Takes the last days of metrics of known corridors. Rows without index or speed do not
    count, although the speed itself is not used. Estimates are summed to nine decimals.
    """
    recent = scan_metrics(metrics, corridors, before(as_of, days=th.baseline_days))
    return (
        _by_hour(recent)
        .agg(
            steady_avg(ESTIMATE).alias("avg_travel_time_sec"),
            F.count("*").alias("sample_count"),
        )
        .withColumn("updated_at", instant(as_of))
    )


def _by_hour(metrics: DataFrame, *more: str):
    return metrics.dropna(subset=["congestion_index", "speed_kmh", "event_time"]).groupBy(
        *more,
        "corridor_id",
        F.weekday("event_time").alias("day_of_week"),
        F.hour("event_time").alias("hour_of_day"),
    )


def baseline_parts(metrics: DataFrame, *more: str) -> DataFrame:
    """What a set of metric rows adds to baselines: sums and counts, also by ``more`` columns.

    Parts of any division of the rows give the baselines of all of them, exactly.
    """
    sums = [F.expr(sql).alias(f"estimate_{name}") for name, sql in steady_parts(ESTIMATE).items()]
    return _by_hour(metrics, *more).agg(*sums, F.count("*").alias("sample_count"))


def baselines_of_parts(parts: DataFrame, corridors: DataFrame, as_of) -> DataFrame:
    """Baselines of known corridors from parts; their rows must lie within the days that count."""
    known = parts.join(corridors.select("corridor_id"), "corridor_id", "left_semi")
    return (
        known.groupBy(*BASELINE_KEYS)
        .agg(
            steady_avg_of_parts("estimate_").alias("avg_travel_time_sec"),
            F.sum("sample_count").alias("sample_count"),
        )
        .withColumn("updated_at", instant(as_of))
    )
