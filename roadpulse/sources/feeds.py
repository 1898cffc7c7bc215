"""Feed sources and the JSON envelope around every event."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse import schemas, settings
from roadpulse.functions.times import moment, parse_iso, parse_weather_time


@dataclass(frozen=True)
class FeedSource:
    """Where a feed comes from.

    ``kafka`` needs ``options={"kafka.bootstrap.servers": ...}`` and the connector on the
    classpath. Any file format (``json``, ``parquet``) reads envelopes landed under ``path``.
    """

    format: str = "kafka"
    path: str | None = None
    topic: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def read_feed(spark: SparkSession, kind: str, source: FeedSource) -> DataFrame:
    """Streaming envelopes (key, value, partition, offset, timestamp) of one feed."""
    if source.format == "kafka":
        options = {
            "subscribe": source.topic or settings.TOPICS[kind],
            "startingOffsets": "latest",
            "failOnDataLoss": "false",
        }
        return spark.readStream.format("kafka").options(**{**options, **source.options}).load()
    return (
        spark.readStream.format(source.format)
        .schema(schemas.ENVELOPE)
        .options(**source.options)
        .load(source.path)
    )


def load_feed(spark: SparkSession, kind: str, source: FeedSource) -> DataFrame:
    """The envelopes a feed holds now, as a batch."""
    if source.format == "kafka":
        options = {"subscribe": source.topic or settings.TOPICS[kind], **source.options}
        return spark.read.format("kafka").options(**options).load()
    reader = spark.read.format(source.format).schema(schemas.ENVELOPE).options(**source.options)
    return reader.load(source.path)


# How far a tail reaches back at first, as a multiple of the wanted span, and how it grows.
_WIDER = 8
_WIDEST = timedelta(days=3660)


def load_tail(
    spark: SparkSession, kind: str, source: FeedSource, as_of=None, span: timedelta = timedelta(minutes=15)
) -> DataFrame:
    """The end of a feed, with its newest message: no more of it is read than that takes.

    A broker is asked for messages from a time on, files for those landed since. Messages do
    not lie ahead of their landing, so once the tail has one from its own span, everything
    before the tail is older. Otherwise the span grows; a feed silent for ten years is read whole.
    """
    now = moment(as_of)
    while span < _WIDEST:
        since = now - span
        tail = _since(spark, kind, source, since)
        if not tail.where(F.col("timestamp") >= F.lit(since)).isEmpty():
            return tail
        span *= _WIDER
    return load_feed(spark, kind, source)


def _since(spark: SparkSession, kind: str, source: FeedSource, since) -> DataFrame:
    if source.format == "kafka":
        options = {
            "startingTimestamp": str(int(since.timestamp() * 1000)),
            "startingOffsetsByTimestampStrategy": "latest",
        }
    else:
        zone = spark.conf.get("spark.sql.session.timeZone")
        options = {"modifiedAfter": since.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%dT%H:%M:%S")}
    return load_feed(spark, kind, replace(source, options={**source.options, **options}))


def decode_feed(
    envelopes: DataFrame,
    kind: str,
    keep: tuple[str, ...] = (),
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """Decode the JSON payload against the fixed schema and type its event time.

    Malformed payloads give rows of nulls and malformed times give null times; the operators
    downstream drop rows without keys. ``keep`` carries envelope columns along. The fields
    come out of a generator, so filters on them stay above it and the text is parsed once;
    since the planner cannot prune them there, ``fields`` names those that are wanted.
    """
    schema = schemas.FEEDS[kind]
    if fields is not None:
        schema = T.StructType([schema[name] for name in fields])
    payload = F.from_json(F.col("value").cast("string"), schema)
    decoded = envelopes.select(*keep, F.inline(F.array(payload)))
    if "event_time" not in schema.names:
        return decoded
    if kind == "traffic":
        return decoded.withColumn("event_time", parse_iso(F.col("event_time")))
    if kind == "weather":
        return decoded.withColumn("event_time", parse_weather_time(F.col("event_time")))
    return decoded


def decode_alerts(messages: DataFrame) -> DataFrame:
    """Alert messages of a channel as rows again, other columns beside them."""
    payload = F.from_json("value", schemas.CONGESTION_ALERTS)
    kept = [c for c in messages.columns if c not in ("key", "value")]
    return messages.select(*kept, F.inline(F.array(payload)))


def encode_feed(events: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Key and JSON value of every event, ready for a topic.

    Time columns must already be text in the feed's own format.
    """
    payload = [c for c in events.columns if c not in keep]
    return events.select(
        *keep,
        F.col(key).alias("key"),
        F.to_json(F.struct(*payload)).alias("value"),
    )


def write_feed(encoded: DataFrame, topic: str, options: dict[str, str]) -> None:
    """Send encoded rows to a broker topic."""
    encoded.select("key", "value").write.format("kafka").options(**options).option(
        "topic", topic
    ).save()
