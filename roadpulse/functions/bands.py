"""Threshold ladders for display and alerts. A missing value counts as zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse import settings as s
from roadpulse.settings import DEFAULTS, Thresholds


def _ladder(index: Column, th: Thresholds, names: tuple[str, str, str, str]) -> Column:
    x = F.coalesce(index, F.lit(0.0))
    severe, moderate, light, free = names
    return (
        F.when(x > th.severe_index, severe)
        .when(x > th.moderate_index, moderate)
        .when(x > th.light_index, light)
        .otherwise(free)
    )


def congestion_band(index: Column, th: Thresholds = DEFAULTS) -> Column:
    return _ladder(index, th, (s.BAND_SEVERE, s.BAND_MODERATE, s.BAND_LIGHT, s.BAND_FREE))


def congestion_color(index: Column, th: Thresholds = DEFAULTS) -> Column:
    return _ladder(index, th, (s.COLOR_RED, s.COLOR_ORANGE, s.COLOR_YELLOW, s.COLOR_GREEN))


def vehicle_color(speed: Column, th: Thresholds = DEFAULTS) -> Column:
    x = F.coalesce(speed, F.lit(0.0))
    return (
        F.when(x < th.vehicle_slow_kmh, s.COLOR_RED)
        .when(x < th.vehicle_medium_kmh, s.COLOR_YELLOW)
        .otherwise(s.COLOR_GREEN)
    )


def alert_icon(index: Column, th: Thresholds = DEFAULTS) -> Column:
    x = F.coalesce(index, F.lit(0.0))
    return (
        F.when(x > th.alert_red_index, s.ICON_RED)
        .when(x > th.alert_orange_index, s.ICON_ORANGE)
        .otherwise(s.ICON_YELLOW)
    )


def severity_color(severity: Column) -> Column:
    """Colour code of a severity; any other severity has the default colour."""
    ladder = F
    for name, color in s.SEVERITY_COLORS:
        ladder = ladder.when(severity == name, color)
    return ladder.otherwise(s.DEFAULT_SEVERITY_COLOR)


def status_icon(is_anomaly: Column) -> Column:
    return F.when(is_anomaly, s.ICON_RED).otherwise(s.ICON_GREEN)
