"""Read queries over the congestion metric table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.bands import congestion_band, congestion_color, status_icon
from roadpulse.functions.numeric import steady_avg
from roadpulse.functions.times import before, instant
from roadpulse.operators.latest import newest_values
from roadpulse.settings import DEFAULTS, Thresholds

_KNOWN = ["corridor_id"]


def scan_metrics(metrics: DataFrame, corridors: DataFrame, since, inclusive: bool = True) -> DataFrame:
    """Metrics of known corridors from ``since`` on, as one filtered scan."""
    t, cutoff = F.col("event_time"), instant(since)
    recent = metrics.where(t >= cutoff if inclusive else t > cutoff)
    return recent.join(corridors.select("corridor_id"), _KNOWN, "left_semi")


def lookup_metric(metrics: DataFrame, keys: DataFrame) -> DataFrame:
    """Metric rows whose (corridor_id, event_time) occur in ``keys``."""
    wanted = keys.select("corridor_id", "event_time")
    return metrics.join(wanted, ["corridor_id", "event_time"], "left_semi")


def _filled() -> list[Column]:
    return [
        F.coalesce("congestion_index", F.lit(0.0)).alias("congestion_index"),
        F.coalesce("speed_kmh", F.lit(0.0)).alias("speed_kmh"),
        F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"),
    ]


def fill_metric_defaults(metrics: DataFrame) -> DataFrame:
    """Display columns with zero or false in place of nulls."""
    return metrics.select("corridor_id", "event_time", *_filled())


def latest_per_corridor(metrics: DataFrame, corridors: DataFrame) -> DataFrame:
    """Newest metric row of every known corridor that has one.

    (corridor_id, event_time) is the table's key, so the newest row is unique and one hash
    aggregate over fixed-width columns finds it: no sort, and one row per corridor and task in
    the shuffle.
    """
    shown = ["corridor_id", "event_time", "congestion_index", "speed_kmh", "is_anomaly"]
    known = metrics.select(*shown).join(corridors.select("corridor_id"), _KNOWN, "left_semi")
    return fill_metric_defaults(newest_values(known, _KNOWN, "event_time"))


def corridor_status(
    corridors: DataFrame, latest: DataFrame, th: Thresholds = DEFAULTS
) -> DataFrame:
    """Every corridor with its newest values, band, colour and status."""
    joined = corridors.join(latest, "corridor_id", "left").select(
        "corridor_id", "name", "city", "event_time", *_filled()
    )
    index = F.col("congestion_index")
    return joined.select(
        "*",
        congestion_band(index, th).alias("band"),
        congestion_color(index, th).alias("color"),
        status_icon(F.col("is_anomaly")).alias("status_icon"),
    )


def kpi_summary(corridors: DataFrame, latest: DataFrame) -> DataFrame:
    """One row of totals over the corridors and their newest metrics."""
    marked = corridors.select("corridor_id").join(
        latest.select("corridor_id", *_filled(), F.lit(True).alias("monitored")),
        "corridor_id",
        "left",
    )
    return marked.agg(
        F.count("*").alias("corridors_total"),
        F.count("monitored").alias("corridors_monitored"),
        F.count_if("is_anomaly").alias("active_anomalies"),
        F.coalesce(steady_avg("congestion_index"), F.lit(0.0)).alias("avg_congestion"),
        F.coalesce(steady_avg("speed_kmh"), F.lit(0.0)).alias("avg_speed"),
    )


def trend_series(
    metrics: DataFrame, corridors: DataFrame, as_of, th: Thresholds = DEFAULTS
) -> DataFrame:
    """Metrics of the last hours per known corridor, oldest first, with defaults filled."""
    recent = scan_metrics(metrics, corridors, before(as_of, hours=th.trend_hours), inclusive=False)
    return fill_metric_defaults(recent).orderBy("corridor_id", "event_time")
