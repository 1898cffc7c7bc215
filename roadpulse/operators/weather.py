"""Weather reports: cleaning and the current view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import schemas, settings
from roadpulse.operators.latest import newest_values


def clean_weather(reports: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Table columns of reports that have a location and a valid time."""
    return reports.where(F.col("location").isNotNull() & F.col("event_time").isNotNull()).select(
        *schemas.WEATHER_METRICS.names, *keep
    )


def describe_weather(metrics: DataFrame, codes: DataFrame) -> DataFrame:
    """Add description and icon of the weather code; unknown or missing codes say so."""
    name, icon = settings.UNKNOWN_WEATHER
    return metrics.join(codes, "weather_code", "left").select(
        *metrics.columns,
        F.coalesce("description", F.lit(name)).alias("description"),
        F.coalesce("icon", F.lit(icon)).alias("icon"),
    )


def weather_now(
    metrics: DataFrame, codes: DataFrame, cities: tuple[str, ...] = settings.WEATHER_CITIES
) -> DataFrame:
    """Latest report of each of the given cities, described.

    ``metrics`` holds one row per location and time, as the table does.
    """
    of_cities = metrics.where(F.col("location").isin(*cities))
    return describe_weather(newest_values(of_cities, ["location"], "event_time"), codes)
