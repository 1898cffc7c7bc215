"""Command line: streaming jobs, daily maintenance, checks and the live report.

Tables live under one root folder: ``congestion_metrics``, ``vehicle_speed_metrics``,
``weather_metrics``, ``congestion_alerts``, ``vehicle_snapshot``, ``corridors`` and
``congestion_baselines``; rejected documents under ``document_rejects`` and checkpoints under
``<root>/_checkpoints``.
"""

from __future__ import annotations

import argparse
import logging
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.times import moment
from roadpulse.plans import daily, report
from roadpulse.schemas import ENVELOPE
from roadpulse.session import STREAM_CONF, build_session
from roadpulse.settings import DEFAULTS, TOPICS
from roadpulse.sources import reference
from roadpulse.sources.feeds import FeedSource, decode_feed, load_feed, load_tail
from roadpulse.streaming import files, jobs, newest, store
from roadpulse.streaming.documents import FEED_OF, DocumentSink
from roadpulse.streaming.outbox import AlertChannel, Outbox
from roadpulse.streaming.progress import BatchAudit, batches_folder

class Tables:
    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.congestion = store.congestion_table(f"{self.root}/congestion_metrics")
        self.vehicles = store.vehicle_table(f"{self.root}/vehicle_speed_metrics")
        self.weather = store.weather_table(f"{self.root}/weather_metrics")
        self.alerts = store.alert_table(f"{self.root}/congestion_alerts")
        self.snapshot = f"{self.root}/vehicle_snapshot"
        self.rejects = f"{self.root}/document_rejects"
        self.corridors = f"{self.root}/corridors"
        self.baselines = f"{self.root}/congestion_baselines"

    def checkpoint(self, kind: str) -> str:
        return f"{self.root}/_checkpoints/{kind}"


def _source(args, kind: str) -> FeedSource:
    extra = dict(option.split("=", 1) for option in args.option)
    if args.bootstrap:
        return FeedSource(options={"kafka.bootstrap.servers": args.bootstrap, **extra})
    if not args.feeds:
        raise SystemExit("give --bootstrap for a broker or --feeds for landed files")
    return FeedSource(format="json", path=f"{args.feeds.rstrip('/')}/{kind}", options=extra)


def _corridors(spark: SparkSession, tables: Tables):
    listed = daily.read_corridors(spark, tables.corridors)
    return reference.monitored_corridors(spark) if listed.isEmpty() else listed


def _channel(args) -> AlertChannel | None:
    if args.alert_topic:
        options = {"kafka.bootstrap.servers": args.bootstrap}
        return AlertChannel(format="kafka", topic=args.alert_topic, options=options)
    return AlertChannel(path=args.alert_path) if args.alert_path else None


def _documents(spark: SparkSession, args, tables: Tables, kind: str) -> tuple[FeedSource, DocumentSink]:
    """Where documents of a kind are landed, and where their feed rows and rejects go."""
    if not args.documents:
        raise SystemExit("give --documents for the landed documents")
    source = FeedSource(format="json", path=f"{args.documents.rstrip('/')}/{kind}")
    lookup = _corridors(spark, tables) if kind == "route" else reference.weather_locations(spark)
    rejects, feed = f"{tables.rejects}/{kind}", FEED_OF[kind]
    if args.bootstrap:
        options = {"kafka.bootstrap.servers": args.bootstrap}
        return source, DocumentSink(lookup, rejects, topic=TOPICS[feed], options=options)
    return source, DocumentSink(lookup, rejects, _source(args, feed).path)


def run_stream(spark: SparkSession, args, tables: Tables) -> None:
    trigger = {"availableNow": True} if args.once else None
    if args.every:
        trigger = {"processingTime": args.every}
    checkpoint = tables.checkpoint(args.kind)
    audited = {
        "traffic": tables.congestion.path, "vehicle": tables.vehicles.path, "weather": tables.weather.path,
    }.get(args.kind, f"{tables.root}/{args.kind}")
    audit = BatchAudit(spark, batches_folder(audited))
    common = {"trigger": trigger, "audit": audit}
    if args.kind == "traffic":
        query = jobs.start_traffic(
            spark, _source(args, "traffic"), tables.congestion, checkpoint, tables.alerts, _channel(args),
            files_per_batch=args.files_per_batch, keep_newest=True, **common,
        )
    elif args.kind == "vehicle":
        query = jobs.start_vehicles(
            spark, _source(args, "vehicle"), tables.vehicles, checkpoint,
            files_per_batch=args.files_per_batch, **common,
        )
    elif args.kind == "snapshot":
        query = jobs.start_vehicle_snapshot(
            spark, _source(args, "vehicle"), tables.snapshot, checkpoint, **common
        )
    elif args.kind == "weather":
        query = jobs.start_weather(
            spark, _source(args, "weather"), tables.weather, checkpoint, keep_newest=True, **common
        )
    else:
        kind = args.kind.removesuffix("-documents")
        source, sink = _documents(spark, args, tables, kind)
        query = jobs.start_documents(spark, kind, source, sink, checkpoint, **common)
    query.awaitTermination()
    audit.wait()


def run_deliver(spark: SparkSession, args, tables: Tables) -> None:
    """Send what the alert channel has missed, without waiting for another batch."""
    Outbox(tables.alerts, _channel(args)).deliver(spark)


def run_daily(spark: SparkSession, args, tables: Tables) -> None:
    if daily.read_corridors(spark, tables.corridors).isEmpty():
        daily.seed_corridors(spark, reference.monitored_corridors(spark), tables.corridors)
    listing = reference.monitored_corridors(spark).drop("distance_km")
    daily.refresh_corridors(spark, listing, tables.corridors)
    for table in (tables.congestion, tables.vehicles, tables.weather, tables.alerts):
        daily.tidy(spark, table, args.as_of)
    daily.add_baseline_parts(spark, tables.congestion)
    corridors = daily.read_corridors(spark, tables.corridors)
    daily.recalculate_baselines(spark, tables.congestion, corridors, tables.baselines, args.as_of)


def run_check(spark: SparkSession, args, tables: Tables) -> bool:
    checks = report.check_tables(
        store.read_newest_day(spark, tables.congestion),
        store.read_newest_day(spark, tables.weather),
        args.as_of,
    )
    healthy = report.log_states(checks, "table_name")
    if args.with_feeds:
        seen, existing = _landed(spark, args)
        feeds = report.check_feeds(spark, seen, existing, args.as_of)
        healthy &= report.log_states(feeds, "topic")
    return healthy


def _landed(spark: SparkSession, args):
    """Places and times of the newest messages of all feeds, and the topics there are.

    Of each feed only the tail is read. A broker is asked for its three topics, and fails for one it does not have.
    """
    seen, existing = [], []
    for kind, topic in TOPICS.items():
        source = _source(args, kind)
        if source.path and not files.exists(spark, source.path):
            continue
        existing.append(topic)
        span = timedelta(minutes=DEFAULTS.freshness_minutes)
        envelopes = load_tail(spark, kind, source, args.as_of, span)
        seen.append(envelopes.select(F.lit(topic).alias("topic"), "partition", "offset", "timestamp"))
    if not seen:
        return spark.createDataFrame([], ENVELOPE), existing
    return reduce(DataFrame.unionByName, seen), existing


def _pings(spark: SparkSession, args, tables: Tables) -> DataFrame:
    """The snapshot job's table if there is one, else the whole vehicle feed."""
    kept = newest.read(spark, tables.snapshot, jobs.PING)
    if kept is not None:
        return kept
    return decode_feed(load_feed(spark, "vehicle", _source(args, "vehicle")), "vehicle", ("offset",))


def run_report(spark: SparkSession, args, tables: Tables) -> None:
    now = moment(args.as_of)
    corridors = _corridors(spark, tables)
    alerts = store.newest_log_rows(spark, tables.alerts, DEFAULTS.recent_alerts)
    frames = report.live_report(
        spark,
        corridors,
        store.read_newest(spark, tables.congestion, "corridor_id", now, known=corridors),
        store.read_table(spark, tables.congestion, now - timedelta(hours=DEFAULTS.trend_hours), now),
        store.read_newest(spark, tables.weather, "location", now),
        _pings(spark, args, tables),
        alerts.select(*tables.alerts.columns.names),
        now,
        ping_order=("offset",),
    )
    for name, frame in frames.items():
        print(f"== {name}")
        if args.output:
            frame.write.mode("overwrite").json(f"{args.output.rstrip('/')}/{name}")
        else:
            _print(frame)
    spark.catalog.clearCache()


def _print(frame: DataFrame) -> None:
    """Print all rows, computed once and fetched one partition at a time."""
    print("\t".join(frame.columns))
    for row in frame.toLocalIterator():
        print("\t".join("" if v is None else str(v).replace("\n", " ") for v in row))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="roadpulse", description=__doc__)
    top.add_argument("--tables", required=True, help="root folder of the tables")
    top.add_argument("--master", default=None)
    top.add_argument("--as-of", default=None, help="moment in UTC; default now")
    top.add_argument("--bootstrap", default=None, help="broker addresses")
    top.add_argument("--feeds", default=None, help="root folder of landed feeds")
    top.add_argument("--documents", default=None, help="root folder of landed API documents")
    top.add_argument(
        "--option",
        action="append",
        default=[],
        metavar="KEY=VALUE",
        help="option of the feed source, such as maxOffsetsPerTrigger=1000000",
    )
    commands = top.add_subparsers(dest="command", required=True)
    stream = commands.add_parser("stream", help="run one streaming job")
    kinds = ["traffic", "vehicle", "weather", "snapshot", "route", "weather-documents"]
    stream.add_argument("kind", choices=kinds)
    stream.add_argument("--once", action="store_true", help="catch up, then stop")
    stream.add_argument("--every", default=None, help="trigger interval, such as '10 seconds'")
    stream.add_argument("--files-per-batch", type=int, default=None)
    deliver = commands.add_parser("deliver", help="send alerts the channel has missed")
    for command in (stream, deliver):
        command.add_argument("--alert-topic", default=None)
        command.add_argument("--alert-path", default=None)
    commands.add_parser("daily", help="refresh corridors and baselines, tidy tables")
    check = commands.add_parser("check", help="check freshness of tables")
    check.add_argument("--with-feeds", action="store_true", help="check the feeds' message times too")
    shown = commands.add_parser("report", help="print the live report")
    shown.add_argument("--output", default=None, help="folder to write the report's parts to instead")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if getattr(args, "alert_topic", None) and not args.bootstrap:
        parser().error("--alert-topic needs --bootstrap")
    if args.command == "deliver" and not (args.alert_topic or args.alert_path):
        parser().error("give --alert-topic or --alert-path")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    conf = STREAM_CONF if args.command == "stream" else None
    spark = build_session(f"roadpulse-{args.command}", args.master, conf)
    tables = Tables(args.tables)
    if args.command == "stream":
        run_stream(spark, args, tables)
    elif args.command == "deliver":
        run_deliver(spark, args, tables)
    elif args.command == "daily":
        run_daily(spark, args, tables)
    elif args.command == "check":
        return 0 if run_check(spark, args, tables) else 1
    else:
        run_report(spark, args, tables)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
