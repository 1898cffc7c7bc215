"""Timestamps: literals, parsing and text."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse import settings


def moment(value: datetime | str | None = None) -> datetime:
    """A moment as an aware datetime; naive moments are UTC, None is now."""
    if value is None:
        return datetime.now(timezone.utc)
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def instant(value: datetime | str | Column | None = None) -> Column:
    """A timestamp column from a moment; naive moments are UTC, None is now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(moment(value))


def before(value: datetime | str | Column | None, **span: int) -> Column:
    """A moment minus days, hours, mins or secs."""
    return instant(value) - F.make_dt_interval(**{k: F.lit(v) for k, v in span.items()})


def parse_iso(c: Column) -> Column:
    """ISO text to timestamp; malformed text becomes null instead of failing the batch."""
    return c.try_cast("timestamp")


def parse_weather_time(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(settings.WEATHER_TIME_FORMAT))


def iso_seconds(c: Column) -> Column:
    """UTC text in whole seconds, as the feeds carry it."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_text(c: Column) -> Column:
    """UTC text with microseconds only where there are any."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    micros = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.pmod(F.unix_micros(c), F.lit(1_000_000)) == 0, whole).otherwise(micros)


def age_minutes(moment: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(moment)) / F.lit(60_000_000)
