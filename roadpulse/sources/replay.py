"""Road feeds and corridor registers derived from general event and key tables.

A table of timed user events stands in for the road sensors: every event becomes one traffic
observation, one vehicle ping and one weather report. All columns are computed row by row
from the input, so the feeds grow with the table and need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import schemas, settings
from roadpulse.functions.times import iso_seconds
from roadpulse.operators.traffic import derive_traffic_metrics


def _pick(values: list, index: str) -> Column:
    """The value at an index, as one SQL expression."""
    items = ", ".join(
        f"'{v}'" if isinstance(v, str) else f"{v}D" if isinstance(v, float) else f"{v}"
        for v in values
    )
    return F.expr(f"element_at(array({items}), cast({index} AS int) + 1)")


def events(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The event table; time bounds (inclusive, exclusive) reach the Parquet scan."""
    df = spark.read.schema(schemas.EVENTS).parquet(f"{sf_dir}/events.parquet")
    if since:
        df = df.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if until:
        df = df.where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return df.selectExpr(
        "event_id",
        "cast(ts AS timestamp) AS event_time",
        "user_id",
        "floor(value * 100 + 0.5D) AS cents",
        "cast(user_id % 6 AS int) AS ix",
    )


def corridor_id() -> Column:
    return _pick([c[0] for c in settings.CORRIDORS], "ix")


def route_times(ev: DataFrame) -> DataFrame:
    """Travel time, free-flow time and length per event; travel can beat free flow."""
    length = _pick([round(c[7] * 1000) for c in settings.CORRIDORS], "ix")
    return (
        ev.withColumns({"corridor_id": corridor_id(), "length_m": length})
        .selectExpr("*", "cast(length_m * 3 div 50 AS int) AS free_flow_sec")
        .selectExpr(
            "*", "cast(free_flow_sec * (cents + 8000) div 10000 AS int) AS travel_time_sec"
        )
    )


def traffic_feed(ev: DataFrame) -> DataFrame:
    """One traffic observation per event, with derived index, speed and flag."""
    named = route_times(ev).select(
        "event_id",
        "corridor_id",
        _pick([c[1] for c in settings.CORRIDORS], "ix").alias("corridor_name"),
        _pick([c[2] for c in settings.CORRIDORS], "ix").alias("city"),
        "travel_time_sec",
        "free_flow_sec",
        "length_m",
        "event_time",
    )
    return derive_traffic_metrics(named)


def vehicle_pings(ev: DataFrame) -> DataFrame:
    """One vehicle ping per event, with its progress along the corridor."""
    return ev.withColumn("corridor_id", corridor_id()).selectExpr(
        "event_id",
        "concat(corridor_id, '_v', (user_id div 6) % 3 + 1) AS vehicle_id",
        "corridor_id",
        "5D + (cents % 4600) / 100D AS speed_kmh",
        "(event_id % 1000) / 1000D AS progress",
        "event_time",
    )


def weather_feed(ev: DataFrame) -> DataFrame:
    """One weather report per event; some lack a location, some carry a malformed time."""
    codes = [c[0] for c in settings.WEATHER_CODES] + [99]
    good = F.date_format("event_time", settings.WEATHER_TIME_FORMAT)
    bad = F.date_format("event_time", "yyyy-MM-dd HH:mm")
    return ev.select(
        "event_id",
        F.when(F.col("event_id") % 101 != 0, _pick(list(settings.WEATHER_CITIES), "user_id % 2"))
        .alias("location"),
        _pick([p[1] for p in settings.WEATHER_LOCATIONS], "user_id % 2").alias("latitude"),
        _pick([p[2] for p in settings.WEATHER_LOCATIONS], "user_id % 2").alias("longitude"),
        F.when(F.col("event_id") % 97 == 0, bad).otherwise(good).alias("event_time"),
        F.expr("15D + (cents % 2500) / 100D AS temperature_c"),
        F.expr("cast(event_id % 100 AS double) AS humidity_pct"),
        F.expr("(event_id % 50) / 10D AS precipitation_mm"),
        F.expr("(user_id % 400) / 10D AS wind_speed_kmh"),
        _pick(codes, "event_id % 17").alias("weather_code"),
    )


def as_payload(feed: DataFrame, kind: str) -> DataFrame:
    """Feed rows with time as text and only the columns the payload carries."""
    if kind == "traffic":
        return feed.withColumn("event_time", iso_seconds(F.col("event_time"))).drop("length_m")
    if kind == "vehicle":
        return feed.withColumn("event_time", iso_seconds(F.col("event_time"))).drop("progress")
    return feed


def corridor_listing(
    keys: DataFrame, key: str, name: str, step: int = 1, keep: str | None = None
) -> DataFrame:
    """A corridor listing with one entry per row of a key table.

    ``step`` spaces the ids, so two listings of different steps overlap only in part. Every
    fifth name and every seventh city is missing.
    """

    def point(lat_factor: int, lon_factor: int) -> str:
        lat = f"30D + (({key} * {lat_factor}) % 10000) / 10000D"
        lon = f"31D + (({key} * {lon_factor}) % 10000) / 10000D"
        return f"named_struct('lat', {lat}, 'lon', {lon})"

    return keys.selectExpr(
        f"concat('c', {key} * {step}) AS id",
        f"CASE WHEN {key} % 5 <> 0 THEN {name} END AS name",
        f"CASE WHEN {key} % 7 <> 0 THEN 'Alexandria' END AS city",
        f"{point(37, 53)} AS start",
        f"{point(71, 89)} AS end",
        *([keep] if keep else []),
    )
