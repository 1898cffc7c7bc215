"""Explicit schemas of feeds, documents and tables. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TRAFFIC_EVENT = T.StructType(
    [
        T.StructField("corridor_id", T.StringType()),
        T.StructField("corridor_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("travel_time_sec", T.IntegerType()),
        T.StructField("free_flow_sec", T.IntegerType()),
        T.StructField("congestion_index", T.DoubleType()),
        T.StructField("speed_kmh", T.DoubleType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("event_time", T.StringType()),
    ]
)

WEATHER_EVENT = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("humidity_pct", T.DoubleType()),
        T.StructField("precipitation_mm", T.DoubleType()),
        T.StructField("wind_speed_kmh", T.DoubleType()),
        T.StructField("weather_code", T.IntegerType()),
    ]
)

VEHICLE_EVENT = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("corridor_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("speed_kmh", T.DoubleType()),
        T.StructField("heading", T.DoubleType()),
        T.StructField("progress_pct", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

FEEDS = {"traffic": TRAFFIC_EVENT, "weather": WEATHER_EVENT, "vehicle": VEHICLE_EVENT}

# What a broker source delivers; file sources carry the same columns as JSON lines.
ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Landed answers of the routing and weather services: what was asked for, when, and the text.
LANDED_DOCUMENT = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("document", T.StringType()),
    ]
)

ROUTE_DOCUMENT = T.StructType(
    [
        T.StructField(
            "routes",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "summary",
                            T.StructType(
                                [
                                    T.StructField("travelTimeInSeconds", T.IntegerType()),
                                    T.StructField("noTrafficTravelTimeInSeconds", T.IntegerType()),
                                    T.StructField("lengthInMeters", T.IntegerType()),
                                ]
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)

WEATHER_DOCUMENT = T.StructType(
    [
        T.StructField(
            "current",
            T.StructType(
                [
                    T.StructField("time", T.StringType()),
                    T.StructField("temperature_2m", T.DoubleType()),
                    T.StructField("relative_humidity_2m", T.DoubleType()),
                    T.StructField("precipitation", T.DoubleType()),
                    T.StructField("wind_speed_10m", T.DoubleType()),
                    T.StructField("weather_code", T.IntegerType()),
                ]
            ),
        )
    ]
)

CONGESTION_METRICS = T.StructType(
    [
        T.StructField("corridor_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("travel_time_sec", T.IntegerType()),
        T.StructField("free_flow_sec", T.IntegerType()),
        T.StructField("congestion_index", T.DoubleType()),
        T.StructField("speed_kmh", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
    ]
)

VEHICLE_SPEED_METRICS = T.StructType(
    [
        T.StructField("corridor_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("avg_speed_kmh", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
    ]
)

WEATHER_METRICS = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("humidity_pct", T.DoubleType()),
        T.StructField("precipitation_mm", T.DoubleType()),
        T.StructField("wind_speed_kmh", T.DoubleType()),
        T.StructField("weather_code", T.IntegerType()),
    ]
)

CONGESTION_ALERTS = T.StructType(
    [
        T.StructField("corridor_id", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("congestion_index", T.DoubleType()),
        T.StructField("speed_kmh", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

CORRIDORS = T.StructType(
    [
        T.StructField("corridor_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("name_ar", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("district_id", T.IntegerType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("start_lon", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("end_lon", T.DoubleType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("baseline_travel_time_sec", T.IntegerType()),
    ]
)

CONGESTION_BASELINES = T.StructType(
    [
        T.StructField("corridor_id", T.StringType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("avg_travel_time_sec", T.DoubleType()),
        T.StructField("std_travel_time_sec", T.DoubleType()),
        T.StructField("sample_count", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# What one date adds to the baselines; see ``baseline_parts``.
BASELINE_PARTS = T.StructType(
    [
        T.StructField("corridor_id", T.StringType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("estimate_low", T.DecimalType(38, 0)),
        T.StructField("estimate_rest", T.DecimalType(38, 0)),
        T.StructField("estimate_large", T.DecimalType(38, 9)),
        T.StructField("estimate_exact", T.LongType()),
        T.StructField("estimate_n", T.LongType()),
        T.StructField("estimate_plain", T.DoubleType()),
        T.StructField("sample_count", T.LongType()),
    ]
)

# Columns read from the general tables that feeds and corridor listings are derived from.
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, value double"
SUPPLIER = "s_suppkey bigint, s_name string"
CUSTOMER = "c_custkey bigint, c_name string"
PART = "p_partkey bigint, p_name string, p_size int"
