"""Raw API documents, landed as JSON text, flattened to feed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import schemas
from roadpulse.functions.times import iso_seconds
from roadpulse.operators.traffic import derive_traffic_metrics
from roadpulse.settings import DEFAULTS, Thresholds
from roadpulse.sources.feeds import FeedSource

# Why a document gives no feed row.
NOT_JSON, NO_ROUTE, NO_VALUE = "not json", "no route", "missing value"
ZERO_TRAVEL, ZERO_FREE, UNKNOWN_KEY = "zero travel time", "zero free flow", "unknown key"


def read_documents(spark: SparkSession, source: FeedSource) -> DataFrame:
    """Landed documents as a stream."""
    reader = spark.readStream.format(source.format).schema(schemas.LANDED_DOCUMENT)
    return reader.options(**source.options).load(source.path)


def _parsed(documents: DataFrame, schema) -> DataFrame:
    """Documents with their parsed form; the generator keeps it from being parsed again."""
    parsed = F.from_json("document", schema)
    return documents.select("*", F.inline(F.array(F.struct(parsed.alias("parsed")))))


def _not_json() -> Column:
    """Only reached for documents without usable values, so good ones are parsed once."""
    return F.try_parse_json("document").isNull()


def judge_route_documents(
    documents: DataFrame, corridors: DataFrame, th: Thresholds = DEFAULTS
) -> DataFrame:
    """Every landed document with its traffic feed row or the ``reason`` it has none.

    The corridor (``key``) must be listed; the event time is when the document was fetched.
    """
    summary = F.get("parsed.routes", F.lit(0))["summary"]
    values = _parsed(documents, schemas.ROUTE_DOCUMENT).select(
        "key", "fetched_at", "document",
        summary["travelTimeInSeconds"].alias("travel_time_sec"),
        summary["noTrafficTravelTimeInSeconds"].alias("free_flow_sec"),
        summary["lengthInMeters"].alias("length_m"),
        summary.isNull().alias("no_route"),
    )
    travel, free = F.col("travel_time_sec"), F.col("free_flow_sec")
    complete = travel.isNotNull() & free.isNotNull() & F.col("length_m").isNotNull()
    flaw = F.when(complete, F.when(travel == 0, ZERO_TRAVEL).when(free == 0, ZERO_FREE)).otherwise(
        F.when(_not_json(), NOT_JSON).when(F.col("no_route"), NO_ROUTE).otherwise(NO_VALUE)
    )
    listed = corridors.select(
        F.col("corridor_id"), F.col("name").alias("corridor_name"), "city"
    )
    joined = values.join(listed, values["key"] == listed["corridor_id"], "left")
    unknown = F.when(F.col("corridor_id").isNull(), UNKNOWN_KEY)
    rows = derive_traffic_metrics(joined.withColumn("reason", F.coalesce(unknown, flaw)), th)
    return rows.withColumn("event_time", iso_seconds(F.col("fetched_at"))).drop("no_route")


def judge_weather_documents(documents: DataFrame, locations: DataFrame) -> DataFrame:
    """Every landed document with its weather feed row or the ``reason`` it has none.

    As in ``flatten_weather_documents`` missing fields or a missing block stay null.
    """
    current = "parsed.current"
    values = _parsed(documents, schemas.WEATHER_DOCUMENT).select(
        "key", "fetched_at", "document",
        F.col(f"{current}.time").alias("event_time"),
        F.col(f"{current}.temperature_2m").alias("temperature_c"),
        F.col(f"{current}.relative_humidity_2m").alias("humidity_pct"),
        F.col(f"{current}.precipitation").alias("precipitation_mm"),
        F.col(f"{current}.wind_speed_10m").alias("wind_speed_kmh"),
        F.col(f"{current}.weather_code").alias("weather_code"),
        F.when(F.col(current).isNull() & _not_json(), NOT_JSON).alias("flaw"),
    )
    joined = values.join(locations, values["key"] == locations["location"], "left")
    unknown = F.when(F.col("location").isNull(), UNKNOWN_KEY)
    return joined.withColumn("reason", F.coalesce(unknown, "flaw")).drop("flaw")


def flatten_route_documents(documents: DataFrame, keep: tuple[str, ...] = ("corridor_id",)) -> DataFrame:
    """Travel time, free-flow time and length of the first route in each ``document``.

    Documents without them, or with a zero time (no index or no speed), are dropped. The route
    comes out of a generator, so each document is parsed once.
    """
    first = F.slice(F.from_json("document", schemas.ROUTE_DOCUMENT)["routes"], 1, 1)
    return (
        documents.select(*keep, F.inline(first))
        .select(
            *keep,
            F.col("summary.travelTimeInSeconds").alias("travel_time_sec"),
            F.col("summary.noTrafficTravelTimeInSeconds").alias("free_flow_sec"),
            F.col("summary.lengthInMeters").alias("length_m"),
        )
        .where(
            (F.col("travel_time_sec") != 0)
            & (F.col("free_flow_sec") != 0)
            & F.col("length_m").isNotNull()
        )
    )


def flatten_weather_documents(
    documents: DataFrame, locations: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Feed columns from the ``current`` block of each ``document``.

    Missing fields, or a missing block, stay null. The place is joined from ``locations``.
    """
    document = F.from_json("document", schemas.WEATHER_DOCUMENT)
    rows = documents.select(*keep, "location", F.inline(F.array(document))).select(
        *keep,
        "location",
        F.col("current.time").alias("event_time"),
        F.col("current.temperature_2m").alias("temperature_c"),
        F.col("current.relative_humidity_2m").alias("humidity_pct"),
        F.col("current.precipitation").alias("precipitation_mm"),
        F.col("current.wind_speed_10m").alias("wind_speed_kmh"),
        F.col("current.weather_code").alias("weather_code"),
    )
    return rows.join(locations, "location", "left")
