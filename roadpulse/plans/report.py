"""The frames of the live report, and the health checks, over stored tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from roadpulse import settings
from roadpulse.operators import alerts as al
from roadpulse.operators import geometry, quality, serving, vehicles, weather
from roadpulse.settings import DEFAULTS, Thresholds
from roadpulse.sources import reference

logger = logging.getLogger("roadpulse.report")


def live_report(
    spark: SparkSession,
    corridors: DataFrame,
    newest_metrics: DataFrame,
    recent_metrics: DataFrame,
    newest_weather: DataFrame,
    pings: DataFrame,
    alert_log: DataFrame,
    as_of=None,
    th: Thresholds = DEFAULTS,
    ping_order: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """Every part of the live report as a frame.

    ``newest_*`` need only hold the newest row per corridor or city, and ``recent_metrics`` only
    the hours of the trend. Several parts share the newest metrics and the vehicle snapshot, which hold one row per
    corridor and vehicle; both are persisted, spilling to disk, until the caller clears them.
    """
    latest = serving.latest_per_corridor(newest_metrics, corridors).persist()
    snapshot = vehicles.vehicle_snapshot(pings, as_of, th, ping_order).persist()
    newest = al.recent_alerts(alert_log, th=th)
    return {
        "kpis": serving.kpi_summary(corridors, latest),
        "corridor_status": serving.corridor_status(corridors, latest, th),
        "map_extent": geometry.map_extent(corridors, th),
        "weather": weather.weather_now(newest_weather, reference.weather_codes(spark)),
        "vehicles_tracked": vehicles.vehicles_tracked(snapshot),
        "vehicle_markers": vehicles.vehicle_markers(snapshot, th),
        "vehicle_distribution": vehicles.vehicle_distribution(corridors, snapshot),
        "trends": serving.trend_series(recent_metrics, corridors, as_of, th),
        "alerts": al.format_alerts(newest, corridors, th),
    }


def check_tables(
    metrics: DataFrame, weather_metrics: DataFrame, as_of=None, th: Thresholds = DEFAULTS
) -> DataFrame:
    """Freshness of the congestion and weather tables."""
    tables = {"congestion_metrics": metrics, "weather_metrics": weather_metrics}
    return quality.table_freshness(tables, as_of, th)


def check_feeds(
    spark: SparkSession,
    envelopes: DataFrame,
    existing: list[str],
    as_of=None,
    th: Thresholds = DEFAULTS,
) -> DataFrame:
    """Freshness of the three topics."""
    topics = reference.topic_names(spark, list(settings.TOPICS.values()), existing)
    return quality.feed_freshness(envelopes, topics, as_of, th)


def log_states(checks: DataFrame, name: str) -> bool:
    """Log one line per check (there are a handful); true when all are healthy."""
    healthy = True
    for row in checks.collect():
        ok = row["status"] == "healthy"
        healthy &= ok
        logger.log(
            logging.INFO if ok else logging.WARNING,
            "%s is %s, newest %s", row[name], row["status"], row["newest"],
        )
    return healthy
