"""Alerts: building, collapsing, formatting and the recent list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import settings
from roadpulse.functions.bands import (
    alert_icon,
    congestion_band,
    congestion_color,
    severity_color,
)
from roadpulse.functions.numeric import fixed_text
from roadpulse.functions.times import instant, iso_text
from roadpulse.operators.latest import latest_by
from roadpulse.settings import DEFAULTS, Thresholds


def build_alerts(metrics: DataFrame, created_at=None) -> DataFrame:
    """One alert per anomalous metric row. A missing number reads ``n/a`` in the message."""
    missing = F.lit("n/a")
    message = F.concat(
        F.lit("High congestion on "),
        F.col("corridor_id"),
        F.lit(": index "),
        F.coalesce(fixed_text("congestion_index", 2), missing),
        F.lit(", speed "),
        F.coalesce(fixed_text("speed_kmh", 1), missing),
        F.lit(" km/h"),
    )
    return metrics.where("is_anomaly").select(
        "corridor_id",
        F.lit(settings.ALERT_TYPE).alias("alert_type"),
        F.lit(settings.ALERT_SEVERITY).alias("severity"),
        "congestion_index",
        "speed_kmh",
        message.alias("message"),
        "event_time",
        instant(created_at).alias("created_at"),
    )


def alert_messages(alerts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Alerts as key and JSON value, times as UTC text; ``keep`` carries columns beside it."""
    payload = alerts.withColumns(
        {
            "event_time": iso_text(F.col("event_time")),
            "created_at": iso_text(F.col("created_at")),
        }
    )
    inside = [c for c in alerts.columns if c not in keep]
    return payload.select(
        *keep, F.col("corridor_id").alias("key"), F.to_json(F.struct(*inside)).alias("value")
    )


def latest_alerts(log: DataFrame, order: tuple[str, ...] = ("created_at",)) -> DataFrame:
    """The last alert raised for every window; updates of a window raise it again."""
    return latest_by(log, ["corridor_id", "event_time"], list(order))


def format_alerts(
    alerts: DataFrame, corridors: DataFrame, th: Thresholds = DEFAULTS
) -> DataFrame:
    """Text card of every alert: title, colour, band, fields and description.

    Missing fields take their defaults, and an unlisted corridor shows its id.
    """
    names = corridors.select("corridor_id", F.col("name").alias("corridor_name"))
    filled = alerts.select(
        F.coalesce("corridor_id", F.lit("unknown")).alias("corridor_id"),
        F.coalesce("severity", F.lit(settings.ALERT_SEVERITY)).alias("severity"),
        F.coalesce("congestion_index", F.lit(0.0)).alias("congestion_index"),
        F.coalesce("speed_kmh", F.lit(0.0)).alias("speed_kmh"),
        F.coalesce(iso_text(F.col("event_time")), F.lit("N/A")).alias("event_time"),
        "message",
    )
    named = filled.join(names, "corridor_id", "left").withColumn(
        "corridor_name", F.coalesce("corridor_name", "corridor_id")
    )
    return named.select(
        "corridor_id",
        F.concat(
            alert_icon(F.col("congestion_index"), th),
            F.lit(" Congestion Alert — "),
            F.col("corridor_name"),
        ).alias("title"),
        severity_color(F.col("severity")).alias("color"),
        congestion_band(F.col("congestion_index"), th).alias("band"),
        congestion_color(F.col("congestion_index"), th).alias("band_color"),
        F.concat(
            F.lit("**"), F.col("corridor_name"), F.lit("**\n`"), F.col("corridor_id"), F.lit("`")
        ).alias("corridor_field"),
        F.concat(F.lit("**"), fixed_text("congestion_index", 2), F.lit("**")).alias("index_field"),
        F.concat(F.lit("**"), fixed_text("speed_kmh", 1), F.lit("** km/h")).alias("speed_field"),
        F.concat(F.lit("`"), F.col("event_time"), F.lit("`")).alias("time_field"),
        F.when(F.col("message") != "", F.col("message")).alias("description"),
    )


def card_messages(cards: DataFrame, footer: str = settings.CARD_FOOTER) -> DataFrame:
    """Cards as JSON documents for a chat channel; a card without description has no such key."""
    fields = F.array(
        *[
            F.struct(F.lit(label).alias("name"), F.col(c).alias("value"), F.lit(line).alias("inline"))
            for c, label, line in settings.CARD_FIELDS
        ]
    )
    card = F.struct(
        "title",
        "color",
        fields.alias("fields"),
        F.struct(F.lit(footer).alias("text")).alias("footer"),
        "description",
    )
    return cards.select(F.col("corridor_id").alias("key"), F.to_json(card).alias("value"))


def recent_alerts(alerts: DataFrame, n: int | None = None, th: Thresholds = DEFAULTS) -> DataFrame:
    """The newest alerts by creation, then by window and corridor."""
    return alerts.orderBy(
        F.desc("created_at"), F.desc("event_time"), "corridor_id"
    ).limit(th.recent_alerts if n is None else n)
