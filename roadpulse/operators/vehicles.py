"""Vehicle pings: windows, snapshot, markers and distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.bands import vehicle_color
from roadpulse.functions.numeric import steady_avg
from roadpulse.functions.times import before
from roadpulse.operators.latest import latest_by
from roadpulse.settings import DEFAULTS, Thresholds


def flag_slow(speed: Column, th: Thresholds = DEFAULTS) -> Column:
    return F.coalesce(speed < th.slow_corridor_kmh, F.lit(False))


def vehicle_windows(pings: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Vehicle speed rows: mean speed per corridor and window, labelled by the window's end."""
    windows = (
        pings.where(F.col("corridor_id").isNotNull() & F.col("event_time").isNotNull())
        .groupBy("corridor_id", F.window("event_time", th.vehicle_window))
        .agg(steady_avg("speed_kmh").alias("avg_speed_kmh"))
    )
    return windows.select(
        "corridor_id",
        F.col("window.end").alias("event_time"),
        "avg_speed_kmh",
        flag_slow(F.col("avg_speed_kmh"), th).alias("is_anomaly"),
    )


def vehicle_snapshot(
    pings: DataFrame, as_of, th: Thresholds = DEFAULTS, tie_breaks: tuple[str, ...] = ()
) -> DataFrame:
    """Latest ping of every vehicle, or nothing once the whole feed has fallen silent.

    The newest ping of the feed is the newest of the latest pings. Rows travel as one struct, so
    that both uses have the same shuffle, which Spark runs once: the feed is read once.
    """
    first = ["event_time", *tie_breaks]
    rest = [c for c in pings.columns if c not in first]
    placed = pings.select("vehicle_id", *first, F.struct(*first, *rest).alias("ping"))
    latest = latest_by(placed, ["vehicle_id"], first)
    newest = latest.agg(F.max("ping").alias("ping")).select("ping.event_time").scalar()
    # the row's own time never exceeds the newest; it keeps the test above the shuffle
    alive = F.greatest(newest, "event_time") >= before(as_of, secs=th.snapshot_ttl_seconds)
    return latest.where(alive).select(*[F.col(f"ping.{c}").alias(c) for c in pings.columns])


def vehicle_markers(snapshot: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Map markers: vehicles with a position, coloured by speed; a missing speed is zero."""
    return snapshot.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "vehicle_id",
        "corridor_id",
        "latitude",
        "longitude",
        F.coalesce("speed_kmh", F.lit(0.0)).alias("speed_kmh"),
        vehicle_color(F.col("speed_kmh"), th).alias("color"),
    )


def vehicle_distribution(corridors: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Vehicles and their mean speed for every corridor, zero where there are none."""
    counts = snapshot.groupBy("corridor_id").agg(
        F.count("*").alias("vehicles"),
        steady_avg("coalesce(speed_kmh, 0D)").alias("avg_speed_kmh"),
    )
    return corridors.join(counts, "corridor_id", "left").select(
        "corridor_id",
        "name",
        F.coalesce("vehicles", F.lit(0)).alias("vehicles"),
        F.coalesce("avg_speed_kmh", F.lit(0.0)).alias("avg_speed_kmh"),
    )


def vehicles_tracked(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(F.count("*").alias("vehicles_tracked"))
