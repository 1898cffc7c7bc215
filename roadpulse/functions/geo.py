"""Great-circle length and bearing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.settings import EARTH_RADIUS_KM


def _square(c: Column) -> Column:
    return c * c


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = (F.radians(lat2) - F.radians(lat1)) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = _square(F.sin(half_dlat)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * _square(F.sin(half_dlon))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Degrees clockwise from north, 0 up to 360."""
    turn = F.radians(lon2 - lon1)
    east = F.sin(turn) * F.cos(F.radians(lat2))
    north = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.cos(turn)
    return F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))


def along(start: Column, end: Column, progress: Column) -> Column:
    """Linear interpolation between two coordinates."""
    return start + progress * (end - start)
