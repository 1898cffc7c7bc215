"""The streaming jobs: three feeds, the vehicle snapshot, and landed API documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadpulse import schemas
from roadpulse.operators.traffic import traffic_windows
from roadpulse.operators.vehicles import vehicle_snapshot, vehicle_windows
from roadpulse.operators.weather import clean_weather
from roadpulse.settings import DEFAULTS, Thresholds
from roadpulse.sources.documents import read_documents
from roadpulse.sources.feeds import FeedSource, decode_feed, read_feed
from roadpulse.streaming import files, newest
from roadpulse.streaming.documents import DocumentSink
from roadpulse.streaming.outbox import AlertChannel
from roadpulse.streaming.progress import BatchAudit
from roadpulse.streaming.sinks import BatchSink, alert_sink, upsert_sink
from roadpulse.streaming.store import UpsertTable

# Payload fields that the window jobs read.
TRAFFIC_FIELDS = ("corridor_id", "event_time", "congestion_index", "speed_kmh")
VEHICLE_FIELDS = ("corridor_id", "event_time", "speed_kmh")

# Rows of the vehicle snapshot.
PING = T.StructType([*schemas.VEHICLE_EVENT.fields, T.StructField("offset", T.LongType())])


def _start(
    rows: DataFrame,
    sink: BatchSink,
    table: UpsertTable | None,
    checkpoint: str,
    mode: str,
    trigger: dict | None,
    logs: Sequence[str] = (),
    audit: BatchAudit | None = None,
) -> StreamingQuery:
    """Start a job. ``trigger`` is passed on; none means as fast as possible.

    The rows of every batch are counted as they pass and appear in the query's progress under
    ``observedMetrics``; ``audit`` records them. Batch numbers restart with a fresh checkpoint
    and would replace older versions, so a table or other output folders (``logs``) that hold
    any must come with the checkpoint that wrote them.
    """
    spark = rows.sparkSession
    if not files.has_children(spark, f"{checkpoint}/offsets"):
        for path in [*([table.path] if table else []), *logs]:
            if any("=" in name for name in files.children(spark, path)):
                raise ValueError(f"{path} holds rows but checkpoint {checkpoint} is new")
    counted = rows.observe("batch", F.count(F.lit(1)).alias("rows"))
    writer = (
        counted.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if audit is not None:
        spark.streams.addListener(audit)
        writer = writer.queryName(audit.name)
    return writer.start()


def start_traffic(
    spark: SparkSession,
    source: FeedSource,
    table: UpsertTable,
    checkpoint: str,
    alerts: UpsertTable | None = None,
    channel: AlertChannel | None = None,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
    now=None,
    th: Thresholds = DEFAULTS,
    keep_newest: bool = False,
    audit: BatchAudit | None = None,
) -> StreamingQuery:
    """Windowed congestion metrics, upserted as windows change, with alerts per change."""
    events = decode_feed(read_feed(spark, "traffic", source), "traffic", fields=TRAFFIC_FIELDS)
    rows = traffic_windows(events.withWatermark("event_time", th.watermarks["traffic"]), th)
    then = alert_sink(alerts, channel, now, files_per_batch) if alerts else None
    logs = [alerts.path] if alerts else []
    logs += [channel.path] if alerts and channel and channel.path else []
    sink = upsert_sink(table, then, files_per_batch, now, keep_newest)
    return _start(rows, sink, table, checkpoint, "update", trigger, logs, audit)


def start_vehicles(
    spark: SparkSession,
    source: FeedSource,
    table: UpsertTable,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
    now=None,
    th: Thresholds = DEFAULTS,
    audit: BatchAudit | None = None,
) -> StreamingQuery:
    """Windowed vehicle speed per corridor, upserted as windows change."""
    pings = decode_feed(read_feed(spark, "vehicle", source), "vehicle", fields=VEHICLE_FIELDS)
    rows = vehicle_windows(pings.withWatermark("event_time", th.watermarks["vehicle"]), th)
    sink = upsert_sink(table, None, files_per_batch, now)
    return _start(rows, sink, table, checkpoint, "update", trigger, audit=audit)


def start_weather(
    spark: SparkSession,
    source: FeedSource,
    table: UpsertTable,
    checkpoint: str,
    trigger: dict | None = None,
    now=None,
    th: Thresholds = DEFAULTS,
    keep_newest: bool = False,
    audit: BatchAudit | None = None,
) -> StreamingQuery:
    """Cleaned weather reports, appended; of equal keys the later offset wins on reading.

    The tasks that read a batch write it; nothing is shuffled.
    """
    reports = decode_feed(read_feed(spark, "weather", source), "weather", keep=("offset",))
    watermarked = reports.withWatermark("event_time", th.watermarks["weather"])
    rows = clean_weather(watermarked, keep=("offset",))
    sink = upsert_sink(table, None, None, now, keep_newest)
    return _start(rows, sink, table, checkpoint, "append", trigger, audit=audit)


def start_vehicle_snapshot(
    spark: SparkSession,
    source: FeedSource,
    folder: str,
    checkpoint: str,
    trigger: dict | None = None,
    audit: BatchAudit | None = None,
) -> StreamingQuery:
    """The latest ping of every vehicle as a table that every batch is merged into.

    A ping counts however late it comes, so there is no watermark and no streaming state: what
    is kept is one row per vehicle in the table. The snapshot's time to live is applied on
    reading (``live_snapshot``), since it also passes while no batch comes.
    """
    pings = decode_feed(read_feed(spark, "vehicle", source), "vehicle", keep=("offset",))
    placed = pings.where(F.col("vehicle_id").isNotNull() & F.col("event_time").isNotNull())

    def merge(batch: DataFrame, batch_id: int) -> None:
        newest.merge(folder, batch.select(*PING.names), ["vehicle_id"], ["event_time", "offset"], batch_id)

    return _start(placed, merge, None, checkpoint, "append", trigger, [folder], audit)


def live_snapshot(spark: SparkSession, folder: str, as_of, th: Thresholds = DEFAULTS) -> DataFrame:
    """The vehicle snapshot from the job's table: one row per vehicle is read, no feed."""
    pings = newest.read(spark, folder, PING)
    if pings is None:
        pings = spark.createDataFrame([], PING)
    return vehicle_snapshot(pings, as_of, th, ("offset",))


def start_documents(
    spark: SparkSession,
    kind: str,
    source: FeedSource,
    sink: DocumentSink,
    checkpoint: str,
    trigger: dict | None = None,
    audit: BatchAudit | None = None,
) -> StreamingQuery:
    """Landed API documents (``route`` or ``weather``) as feed rows, and the rest as rejects."""
    documents = read_documents(spark, source)
    outputs = [p for p in (sink.feed_path, sink.rejects_path) if p]
    return _start(documents, sink.writer(kind), None, checkpoint, "append", trigger, outputs, audit)
