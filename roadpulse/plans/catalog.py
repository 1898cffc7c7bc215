"""Every query of the engine over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse import schemas, settings
from roadpulse.functions.numeric import round_exact
from roadpulse.functions.times import iso_text, parse_weather_time
from roadpulse.operators import alerts as al
from roadpulse.operators import geometry, merge, quality, serving, vehicles, weather
from roadpulse.operators.baselines import BASELINE_KEYS, BASELINE_VALUES, baselines
from roadpulse.operators.latest import newest_values
from roadpulse.operators.traffic import traffic_windows
from roadpulse.plans import daily
from roadpulse.session import configure, workspace
from roadpulse.sources import reference, replay
from roadpulse.sources.documents import flatten_route_documents, flatten_weather_documents
from roadpulse.sources.feeds import decode_alerts, decode_feed, encode_feed
from roadpulse.streaming import jobs, store
from roadpulse.streaming.documents import DocumentSink
from roadpulse.streaming.outbox import AlertChannel, Outbox
from roadpulse.streaming.progress import BatchAudit, batches_folder, read_batches
from roadpulse.streaming.replay import FailingChannel, envelopes
from roadpulse.streaming.replay import replay as run_replay

Query = Callable[[SparkSession, str], DataFrame]

# The events end late on 2024-01-30; queries read the tables as of the midnight after.
AS_OF = "2024-01-31 00:00:00"
# Events up to here come a second time, too late, where late rows are counted.
LATE_UNTIL = "2024-01-02 00:00:00"
# Moments at which the streaming jobs are stopped and restarted, inside their windows.
SLICE_BOUNDS = (None, "2024-01-08 00:03:00", "2024-01-16 12:03:00", "2024-01-24 06:03:00", None)

_QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so results read the same in any client."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain(fn(configure(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        _QUERIES[name] = run
        return run

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs -----------------------------------------------------------------------------


def _minus(moment: str, **span: float) -> str:
    return str(datetime.fromisoformat(moment) - timedelta(**span))


def _traffic(spark, sf_dir, since=None, until=None) -> DataFrame:
    return replay.traffic_feed(replay.events(spark, sf_dir, since, until))


def _pings(spark, sf_dir) -> DataFrame:
    """Vehicle pings before they are placed on the map."""
    return replay.vehicle_pings(replay.events(spark, sf_dir))


def _placed_pings(spark, sf_dir) -> DataFrame:
    return geometry.ping_positions(_pings(spark, sf_dir), reference.monitored_corridors(spark))


def _metrics(spark, sf_dir, since=None, until=None) -> DataFrame:
    """Congestion metrics; windows ending at or after ``since`` are whole.

    A window starts at most one window length before its end, so older events are not read.
    """
    start = _minus(since, minutes=10) if since else None
    return traffic_windows(_traffic(spark, sf_dir, start, until))


def _weather_reports(spark, sf_dir) -> DataFrame:
    """Decoded weather reports with their event number; malformed times are null."""
    feed = replay.weather_feed(replay.events(spark, sf_dir))
    return feed.withColumn("event_time", parse_weather_time(F.col("event_time")))


def _weather_rows(spark, sf_dir) -> DataFrame:
    return weather.clean_weather(_weather_reports(spark, sf_dir), keep=("event_id",))


def _weather_table(spark, sf_dir) -> DataFrame:
    """Weather rows by location and time; the later report wins."""
    rows = _weather_rows(spark, sf_dir)
    return newest_values(rows, ["location", "event_time"], "event_id").drop("event_id")


def _listing(spark, sf_dir, table, key, name, step=1) -> DataFrame:
    keys = spark.read.schema(getattr(schemas, table.upper())).parquet(f"{sf_dir}/{table}.parquet")
    return reference.load_corridors(replay.corridor_listing(keys, key, name, step))


def _listing_target(spark, sf_dir) -> DataFrame:
    """A corridor table as an earlier load left it, with road lengths."""
    keys = spark.read.schema(schemas.PART).parquet(f"{sf_dir}/part.parquet")
    rows = replay.corridor_listing(keys, "p_partkey", "p_name", 2, keep="p_size")
    return reference.load_corridors(
        rows, F.col("p_size").cast("double").alias("distance_km")
    )


# --- traffic, vehicles, weather ---------------------------------------------------------


@query("traffic_metrics")
def _traffic_metrics_query(spark, sf_dir):
    """Index, speed, distance and flag of every traffic observation."""
    return _traffic(spark, sf_dir)


@query("traffic_windows")
def _traffic_windows_query(spark, sf_dir):
    """Mean index and speed per corridor and ten minutes, with the anomaly flag."""
    return _metrics(spark, sf_dir)


@query("vehicle_windows")
def _vehicle_windows_query(spark, sf_dir):
    """Mean vehicle speed per corridor and five minutes, with the slow flag."""
    return vehicles.vehicle_windows(_pings(spark, sf_dir))


@query("weather_clean")
def _weather_clean_query(spark, sf_dir):
    """Weather table rows; of equal keys the later report wins."""
    return _weather_table(spark, sf_dir)


# --- decode, encode, documents ----------------------------------------------------------


def _damage(encoded: DataFrame) -> DataFrame:
    """Break some payloads: unreadable text, or a fraction where an integer belongs."""
    broken = F.concat(F.lit("#"), F.col("value"))
    fraction = F.regexp_replace("value", '"travel_time_sec":(\\d+)', '"travel_time_sec":$1.5')
    return encoded.withColumn(
        "value",
        F.when(F.col("event_id") % 97 == 0, broken)
        .when(F.col("event_id") % 89 == 0, fraction)
        .otherwise(F.col("value"))
        .cast("binary"),
    )


def _decoded(feed: DataFrame, kind: str, key: str) -> DataFrame:
    encoded = encode_feed(replay.as_payload(feed, kind), key, keep=("event_id",))
    return decode_feed(_damage(encoded), kind, keep=("event_id",))


@query("decode_traffic")
def _decode_traffic_query(spark, sf_dir):
    """Traffic payload bytes decoded; broken payloads and fields become nulls."""
    return _decoded(_traffic(spark, sf_dir), "traffic", "corridor_id")


@query("decode_vehicle")
def _decode_vehicle_query(spark, sf_dir):
    """Vehicle payload bytes decoded, time included."""
    return _decoded(_placed_pings(spark, sf_dir), "vehicle", "vehicle_id")


@query("decode_weather")
def _decode_weather_query(spark, sf_dir):
    """Weather payload bytes decoded; malformed times become null."""
    feed = replay.weather_feed(replay.events(spark, sf_dir))
    return _decoded(feed, "weather", "location")


@query("encode_decode_roundtrip")
def _encode_decode_roundtrip_query(spark, sf_dir):
    """Traffic events keyed by corridor, encoded and decoded again."""
    feed = replay.as_payload(_traffic(spark, sf_dir), "traffic")
    encoded = encode_feed(feed, "corridor_id", keep=("event_id",))
    return decode_feed(encoded, "traffic", keep=("event_id", "key"))


@query("route_document_flatten")
def _route_document_flatten_query(spark, sf_dir):
    """Route documents flattened; incomplete ones and zero times are dropped."""
    times = replay.route_times(replay.events(spark, sf_dir))
    summary = F.struct(
        F.col("travel_time_sec").alias("travelTimeInSeconds"),
        F.when(F.col("event_id") % 101 == 0, 0)
        .otherwise(F.col("free_flow_sec"))
        .alias("noTrafficTravelTimeInSeconds"),
        F.col("length_m").alias("lengthInMeters"),
    )
    full = F.to_json(F.struct(F.array(F.struct(summary.alias("summary"))).alias("routes")))
    documents = times.select(
        "event_id",
        "corridor_id",
        F.when(F.col("event_id") % 97 == 0, '{"routes":[]}').otherwise(full).alias("document"),
    )
    return flatten_route_documents(documents, keep=("event_id", "corridor_id"))


@query("weather_document_flatten")
def _weather_document_flatten_query(spark, sf_dir):
    """Weather documents flattened; a missing block leaves nulls."""
    feed = replay.weather_feed(replay.events(spark, sf_dir))
    current = F.struct(
        F.col("event_time").alias("time"),
        F.col("temperature_c").alias("temperature_2m"),
        F.col("humidity_pct").alias("relative_humidity_2m"),
        F.col("precipitation_mm").alias("precipitation"),
        F.col("wind_speed_kmh").alias("wind_speed_10m"),
        "weather_code",
    )
    documents = feed.select(
        "event_id",
        F.coalesce("location", F.lit("Elsewhere")).alias("location"),
        F.when(F.col("event_id") % 97 == 0, "{}")
        .otherwise(F.to_json(F.struct(current.alias("current"))))
        .alias("document"),
    )
    return flatten_weather_documents(
        documents, reference.weather_locations(spark), keep=("event_id",)
    )


# --- corridors --------------------------------------------------------------------------


@query("corridor_reference")
def _corridor_reference_query(spark, sf_dir):
    """A corridor listing flattened, with default names and cities."""
    return _listing(spark, sf_dir, "supplier", "s_suppkey", "s_name")


@query("corridor_merge")
def _corridor_merge_query(spark, sf_dir):
    """A new corridor listing merged into an older table; road lengths stay."""
    source = _listing(spark, sf_dir, "customer", "c_custkey", "c_name", 3)
    target = _listing_target(spark, sf_dir)
    return merge.merge_by_key(target, source, ["corridor_id"], merge.CORRIDOR_UPDATES)


@query("corridor_seed_insert")
def _corridor_seed_insert_query(spark, sf_dir):
    """Corridors of a listing added where the table lacks them."""
    source = _listing(spark, sf_dir, "customer", "c_custkey", "c_name", 3)
    return merge.insert_if_absent(_listing_target(spark, sf_dir), source, ["corridor_id"])


@query("corridor_geometry")
def _corridor_geometry_query(spark, sf_dir):
    """Length (to the millimetre) and heading of every listed corridor."""
    corridors = _listing(spark, sf_dir, "part", "p_partkey", "p_name")
    return geometry.corridor_geometry(corridors).select(
        "corridor_id", round_exact("length_km", 6).alias("length_km"), "heading"
    )


@query("map_extent")
def _map_extent_query(spark, sf_dir):
    """Centre and padded bounds of all listed corridors."""
    return geometry.map_extent(_listing(spark, sf_dir, "customer", "c_custkey", "c_name"))


@query("ping_positions")
def _ping_positions_query(spark, sf_dir):
    """Every ping placed along its corridor."""
    return _placed_pings(spark, sf_dir)


# --- serving ----------------------------------------------------------------------------


@query("metrics_since")
def _metrics_since_query(spark, sf_dir):
    """Metrics of the last seven days for the corridors of one city."""
    since = _minus(AS_OF, days=7)
    known = reference.monitored_corridors(spark).where(F.col("city") == "Cairo")
    return serving.scan_metrics(_metrics(spark, sf_dir, since), known, since)


@query("metric_point_lookup")
def _metric_point_lookup_query(spark, sf_dir):
    """Congestion metrics at the moments at which vehicles were slow."""
    slow = vehicles.vehicle_windows(_pings(spark, sf_dir)).where("is_anomaly")
    return serving.lookup_metric(_metrics(spark, sf_dir), slow)


@query("stored_point_lookup")
def _stored_point_lookup_query(spark, sf_dir):
    """The same from a stored and folded table, whose files skip what is not asked for."""
    table = store.congestion_table(f"{workspace(spark, 'lookup')}/metrics")
    store.write_version(_metrics(spark, sf_dir), table, 0, AS_OF)
    store.fold(spark, table, AS_OF)
    slow = vehicles.vehicle_windows(_pings(spark, sf_dir)).where("is_anomaly")
    return store.lookup(spark, table, slow).drop("ingested_at")


def _latest(spark, sf_dir) -> DataFrame:
    return serving.latest_per_corridor(
        _metrics(spark, sf_dir), reference.monitored_corridors(spark)
    )


@query("latest_per_corridor")
def _latest_per_corridor_query(spark, sf_dir):
    """Newest metric row per corridor."""
    return _latest(spark, sf_dir)


@query("corridor_status")
def _corridor_status_query(spark, sf_dir):
    """Every corridor with its newest values and band."""
    return serving.corridor_status(reference.monitored_corridors(spark), _latest(spark, sf_dir))


@query("kpi_summary")
def _kpi_summary_query(spark, sf_dir):
    """Totals over corridors and their newest metrics."""
    return serving.kpi_summary(reference.monitored_corridors(spark), _latest(spark, sf_dir))


@query("trend_series")
def _trend_series_query(spark, sf_dir):
    """The last two hours of every corridor, in order."""
    since = _minus(AS_OF, hours=2)
    return serving.trend_series(
        _metrics(spark, sf_dir, since), reference.monitored_corridors(spark), AS_OF
    )


@query("weather_now")
def _weather_now_query(spark, sf_dir):
    """Latest weather per city with its description."""
    return weather.weather_now(_weather_table(spark, sf_dir), reference.weather_codes(spark))


def _snapshot(spark, sf_dir) -> DataFrame:
    """The snapshot as of the feed's newest ping, which a scalar subquery looks up."""
    newest = replay.events(spark, sf_dir).agg(F.max("event_time")).scalar()
    return vehicles.vehicle_snapshot(_pings(spark, sf_dir), newest, tie_breaks=("event_id",))


def _placed_snapshot(spark, sf_dir) -> DataFrame:
    """One ping per vehicle is placed, not the whole feed."""
    return geometry.ping_positions(
        _snapshot(spark, sf_dir), reference.monitored_corridors(spark)
    )


@query("vehicle_snapshot")
def _vehicle_snapshot_query(spark, sf_dir):
    """Latest ping of every vehicle while the feed is alive."""
    return _placed_snapshot(spark, sf_dir)


@query("vehicle_markers")
def _vehicle_markers_query(spark, sf_dir):
    """Map markers of the snapshot, coloured by speed."""
    return vehicles.vehicle_markers(_placed_snapshot(spark, sf_dir))


@query("vehicle_distribution")
def _vehicle_distribution_query(spark, sf_dir):
    """Vehicles and mean speed per corridor of the snapshot."""
    return vehicles.vehicle_distribution(
        reference.monitored_corridors(spark), _snapshot(spark, sf_dir)
    )


@query("vehicles_tracked")
def _vehicles_tracked_query(spark, sf_dir):
    """Number of vehicles in the snapshot."""
    return vehicles.vehicles_tracked(_snapshot(spark, sf_dir))


# --- alerts -----------------------------------------------------------------------------


@query("congestion_alerts")
def _congestion_alerts_query(spark, sf_dir):
    """One alert per anomalous window, with message and UTC text of its time."""
    built = al.build_alerts(_metrics(spark, sf_dir), AS_OF)
    return built.withColumn("event_time_text", iso_text(F.col("event_time")))


@query("alert_cards")
def _alert_cards_query(spark, sf_dir):
    """Alert cards; corridors missing from the list show their id."""
    known = reference.monitored_corridors(spark).where(F.col("corridor_id") != "july26")
    built = al.build_alerts(_metrics(spark, sf_dir), AS_OF)
    return al.format_alerts(built, known)


@query("recent_alerts")
def _recent_alerts_query(spark, sf_dir):
    """The twenty newest alerts."""
    return al.recent_alerts(al.build_alerts(_metrics(spark, sf_dir), AS_OF))


@query("latest_alerts")
def _latest_alerts_query(spark, sf_dir):
    """The last raise of every window of a log in which the hours up to noon raised twice."""
    built = al.build_alerts(_metrics(spark, sf_dir), _minus(AS_OF, days=1))
    again = al.build_alerts(_metrics(spark, sf_dir).where(F.hour("event_time") < 12), AS_OF)
    return al.latest_alerts(built.unionByName(again))


@query("alert_card_messages")
def _alert_card_messages_query(spark, sf_dir):
    """Alert cards as the JSON documents of a chat channel."""
    built = al.build_alerts(_metrics(spark, sf_dir), AS_OF)
    return al.card_messages(al.format_alerts(built, reference.monitored_corridors(spark)))


# --- maintenance ------------------------------------------------------------------------


def _baselines(spark, sf_dir, as_of) -> DataFrame:
    metrics = _metrics(spark, sf_dir, _minus(as_of, days=7), until=as_of)
    return baselines(metrics, reference.monitored_corridors(spark), as_of)


@query("baselines")
def _baselines_query(spark, sf_dir):
    """Baselines of the last seven days by corridor, weekday and hour."""
    return _baselines(spark, sf_dir, AS_OF)


@query("baseline_merge")
def _baseline_merge_query(spark, sf_dir):
    """This week's baselines merged over last week's; stale keys stay."""
    old = _baselines(spark, sf_dir, _minus(AS_OF, days=7))
    new = _baselines(spark, sf_dir, AS_OF)
    return merge.merge_by_key(old, new, BASELINE_KEYS, BASELINE_VALUES)


@query("baseline_orphans")
def _baseline_orphans_query(spark, sf_dir):
    """Baselines whose corridor is not listed."""
    listed = reference.monitored_corridors(spark).where(F.col("corridor_id") != "salah_salem")
    return merge.orphan_rows(_baselines(spark, sf_dir, AS_OF), listed, ["corridor_id"])


@query("baseline_parts")
def _baseline_parts_query(spark, sf_dir):
    """Baselines of a stored table, from parts of its folded dates and rows of the others."""
    table = store.congestion_table(f"{workspace(spark, 'baselines')}/metrics")
    store.write_version(_metrics(spark, sf_dir), table, 0, AS_OF)
    store.fold(spark, table, _minus(AS_OF, days=1))
    daily.add_baseline_parts(spark, table, _minus(AS_OF, days=7))
    return daily.stored_baselines(spark, table, reference.monitored_corridors(spark), AS_OF)


@query("retention_filter")
def _retention_filter_query(spark, sf_dir):
    """Traffic rows still within thirty days of their writing on 2024-02-15."""
    as_of = "2024-02-15 00:00:00"
    rows = _traffic(spark, sf_dir, since=_minus(as_of, days=30))
    return merge.expire(rows.withColumn("ingested_at", F.col("event_time")), as_of)


# --- quality ----------------------------------------------------------------------------


@query("feed_freshness")
def _feed_freshness_query(spark, sf_dir):
    """State of the three topics: one current, one silent for a day, one absent."""

    def topic(kind, until=None):
        return replay.events(spark, sf_dir, until=until).select(
            F.lit(settings.TOPICS[kind]).alias("topic"),
            (F.col("user_id") % 3).alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("event_time").alias("timestamp"),
        )

    seen = topic("traffic").unionByName(topic("weather", until="2024-01-30 00:00:00"))
    expected = list(settings.TOPICS.values())
    topics = reference.topic_names(
        spark, expected, [settings.TOPICS["traffic"], settings.TOPICS["weather"]]
    )
    return quality.feed_freshness(seen, topics, AS_OF)


@query("table_freshness")
def _table_freshness_query(spark, sf_dir):
    """State of the congestion and weather tables."""
    tables = {
        "congestion_metrics": _metrics(spark, sf_dir),
        "weather_metrics": _weather_rows(spark, sf_dir),
    }
    return quality.table_freshness(tables, AS_OF)


@query("metric_reconcile")
def _metric_reconcile_query(spark, sf_dir):
    """Metrics against a copy with lost rows, tiny shifts and real shifts."""
    want = _metrics(spark, sf_dir)
    place = F.col("corridor_id")
    shift = F.when(place == "july26", 1e-7).when(place == "ring_road", 1e-3).otherwise(0.0)
    got = want.where(
        (place != "salah_salem") | (F.col("event_time") < F.lit("2024-01-20").cast("timestamp"))
    ).withColumn("congestion_index", F.col("congestion_index") + shift)
    return quality.reconcile(want, got, ["corridor_id", "event_time"])


# --- streaming --------------------------------------------------------------------------


def _slices(spark, sf_dir, kind):
    for since, until in zip(SLICE_BOUNDS, SLICE_BOUNDS[1:]):
        ev = replay.events(spark, sf_dir, since, until)
        if kind == "traffic":
            feed = replay.traffic_feed(ev)
        elif kind == "vehicle":
            feed = geometry.ping_positions(
                replay.vehicle_pings(ev), reference.monitored_corridors(spark)
            )
        else:
            feed = replay.weather_feed(ev)
        yield envelopes(feed, kind)


def _state_partitions(spark) -> int:
    """State partitions of the job, fixed by its first start: those of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _run_traffic(spark, sf_dir, channel=None, keep_newest=False, late=None):
    """Run the traffic job over the slices, one restart per slice; ``late`` rows come last.

    Alerts are logged when there is a ``channel``, a function of the job's folder.
    """
    home = workspace(spark, "traffic")
    table = store.congestion_table(f"{home}/metrics")
    log = store.alert_table(f"{home}/alerts")
    audits = []

    def start(session, source):
        audits.append(BatchAudit(session, batches_folder(table.path)))
        return jobs.start_traffic(
            session,
            source,
            table,
            f"{home}/checkpoint",
            alerts=log if channel else None,
            channel=channel(home) if channel else None,
            trigger={"availableNow": True},
            now=AS_OF,
            keep_newest=keep_newest,
            audit=audits[-1],
        )

    slices = list(_slices(spark, sf_dir, "traffic"))
    if late is not None:
        slices.append(envelopes(late, "traffic"))
    run_replay(spark, slices, f"{home}/feed", start, _state_partitions(spark))
    for audit in audits:
        audit.wait()
    return table, log, home


def _messages(home: str) -> AlertChannel:
    return AlertChannel(path=f"{home}/messages")


@query("stream_traffic_windows")
def _stream_traffic_windows_query(spark, sf_dir):
    """Final state of the traffic job after several restarts."""
    table, _, _ = _run_traffic(spark, sf_dir)
    return store.read_table(spark, table).drop("ingested_at")


@query("stream_alerts")
def _stream_alerts_query(spark, sf_dir):
    """Every alert the traffic job raised, its log folded; a window raises again when it changes."""
    _, log, _ = _run_traffic(spark, sf_dir, channel=_messages)
    store.fold(spark, log, "2024-01-20")
    rows = store.read_log(spark, log)
    return rows.select(
        (F.col("version") / 2).cast("long").alias("batch_id"), *log.columns.names
    )


@query("alert_delivery")
def _alert_delivery_query(spark, sf_dir):
    """Every logged alert and how often its channel got it, when the channel's first two sends failed."""

    def failing(home):
        return FailingChannel(path=f"{home}/messages", failures=2)

    _, log, home = _run_traffic(spark, sf_dir, channel=failing)
    channel = failing(home)
    # alerts of the last batches may have met the failures only
    Outbox(log, channel).catch_up(spark, channel.failures + 1)
    got = decode_alerts(channel.received(spark))
    sent = got.groupBy("version", "corridor_id", "event_time").agg(F.count("*").alias("times_sent"))
    logged = store.read_log(spark, log).select("version", "corridor_id", "event_time", "message")
    both = logged.join(sent, ["version", "corridor_id", "event_time"], "full_outer")
    return both.select(
        (F.col("version") / 2).cast("long").alias("batch_id"), "corridor_id", "event_time", "message",
        F.coalesce("times_sent", F.lit(0)).alias("times_sent"),
    )


@query("stream_latest_per_corridor")
def _stream_latest_per_corridor_query(spark, sf_dir):
    """Newest metric row per corridor from the table that every batch is merged into."""
    table, _, _ = _run_traffic(spark, sf_dir, keep_newest=True)
    rows = store.read_newest(spark, table, "corridor_id")
    return serving.latest_per_corridor(rows, reference.monitored_corridors(spark))


@query("batch_audit")
def _batch_audit_query(spark, sf_dir):
    """What the traffic job read, wrote and dropped per batch, the first day coming again last.

    Rows written are told by the run itself and by the table's ledger, after all was folded.
    """
    again = replay.traffic_feed(replay.events(spark, sf_dir, until=LATE_UNTIL))
    table, _, _ = _run_traffic(spark, sf_dir, late=again)
    store.fold(spark, table, "9999-01-01")
    recorded = store.lasting_audit(spark, table).withColumnRenamed("rows_written", "rows_recorded")
    batches = read_batches(spark, table.path).where("rows_read > 0")
    return batches.join(recorded, "batch_id", "left").na.fill(0, ["rows_recorded"])


@query("stream_vehicle_windows")
def _stream_vehicle_windows_query(spark, sf_dir):
    """Final state of the vehicle job after several restarts."""
    home = workspace(spark, "vehicles")
    table = store.vehicle_table(f"{home}/metrics")

    def start(session, source):
        return jobs.start_vehicles(
            session, source, table, f"{home}/checkpoint",
            trigger={"availableNow": True}, now=AS_OF,
        )

    run_replay(
        spark, _slices(spark, sf_dir, "vehicle"), f"{home}/feed", start, _state_partitions(spark)
    )
    return store.read_table(spark, table).drop("ingested_at")


@query("stream_weather_clean")
def _stream_weather_clean_query(spark, sf_dir):
    """Final state of the weather job after several restarts."""
    home = workspace(spark, "weather")
    table = store.weather_table(f"{home}/metrics")

    def start(session, source):
        return jobs.start_weather(
            session, source, table, f"{home}/checkpoint",
            trigger={"availableNow": True}, now=AS_OF,
        )

    run_replay(spark, _slices(spark, sf_dir, "weather"), f"{home}/feed", start)
    return store.read_table(spark, table).drop("ingested_at")


@query("stream_vehicle_snapshot")
def _stream_vehicle_snapshot_query(spark, sf_dir):
    """The vehicle snapshot of the job's table after several restarts."""
    home = workspace(spark, "snapshot")

    def start(session, source):
        return jobs.start_vehicle_snapshot(
            session, source, f"{home}/snapshot", f"{home}/checkpoint", trigger={"availableNow": True}
        )

    run_replay(spark, _slices(spark, sf_dir, "vehicle"), f"{home}/feed", start)
    newest = replay.events(spark, sf_dir).agg(F.max("event_time")).scalar()
    return jobs.live_snapshot(spark, f"{home}/snapshot", newest).withColumnRenamed("offset", "event_id")


# --- landed documents -------------------------------------------------------------------


def _route_documents(spark, sf_dir, since=None, until=None) -> DataFrame:
    """Answers of a routing service for every event, some of them flawed."""
    times = replay.route_times(replay.events(spark, sf_dir, since, until))
    n = F.col("event_id")
    summary = F.struct(
        F.when(n % 103 == 0, 0).otherwise(F.col("travel_time_sec")).alias("travelTimeInSeconds"),
        F.when(n % 101 == 0, 0).otherwise(F.col("free_flow_sec")).alias("noTrafficTravelTimeInSeconds"),
        F.when(n % 79 != 0, F.col("length_m")).alias("lengthInMeters"),
    )
    full = F.to_json(F.struct(F.array(F.struct(summary.alias("summary"))).alias("routes")))
    return times.select(
        F.when(n % 83 == 0, "elsewhere").otherwise(F.col("corridor_id")).alias("key"),
        F.col("event_time").alias("fetched_at"),
        F.when(n % 97 == 0, '{"routes":[]}').when(n % 89 == 0, F.concat(F.lit("#"), full)).otherwise(full).alias("document"),
    )


def _run_documents(spark, sf_dir) -> str:
    home = workspace(spark, "documents")

    def start(session, source):
        sink = DocumentSink(reference.monitored_corridors(spark), f"{home}/rejects", f"{home}/traffic")
        return jobs.start_documents(
            session, "route", source, sink, f"{home}/checkpoint", trigger={"availableNow": True}
        )

    slices = (_route_documents(spark, sf_dir, a, b) for a, b in zip(SLICE_BOUNDS, SLICE_BOUNDS[1:]))
    run_replay(spark, slices, f"{home}/landed", start)
    return home


@query("document_rejects")
def _document_rejects_query(spark, sf_dir):
    """Landed route documents that gave no feed row, with the reason."""
    rejects = spark.read.parquet(f"{_run_documents(spark, sf_dir)}/rejects")
    return rejects.select("key", "fetched_at", "reason")


@query("document_feed")
def _document_feed_query(spark, sf_dir):
    """The traffic feed that the landed route documents became, decoded."""
    landed = spark.read.schema(schemas.ENVELOPE).json(f"{_run_documents(spark, sf_dir)}/traffic")
    return decode_feed(landed, "traffic")
