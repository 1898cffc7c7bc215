"""Reading little: key lookups in folded dates, and the tails of feeds."""

import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from helpers import plan, rows
from roadpulse.operators.quality import feed_freshness
from roadpulse.operators.serving import lookup_metric
from roadpulse.sources import feeds, reference
from roadpulse.sources.feeds import FeedSource
from roadpulse.streaming import store

DAY_ROWS = 300 * 600


def _dense(spark):
    """A date with 300 corridors and 600 rows each."""
    n = F.col("id")
    at = F.lit("2025-04-01").cast("timestamp") + F.make_dt_interval(secs=(n % 600) * 100)
    return spark.range(DAY_ROWS).select(
        F.format_string("c%03d", F.floor(n / 600)).alias("corridor_id"), at.alias("event_time"),
        F.lit(0).alias("travel_time_sec"), F.lit(0).alias("free_flow_sec"),
        F.hash("id").cast("double").alias("congestion_index"), F.hash(n + 1).cast("double").alias("speed_kmh"),
        (n % 2 == 0).alias("is_anomaly"),
    )


def _scanned(df):
    """Rows that the scans of a finished query gave on."""
    final = df._jdf.queryExecution().executedPlan()
    todo, total = [final], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        elif name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_few_keys_read_a_small_share_of_a_folded_date(spark, home):
    table = store.congestion_table(f"{home}/metrics")
    store.write_version(_dense(spark), table, 0)
    store.write_version(_dense(spark).withColumn("event_time", F.col("event_time") + F.expr("interval 1 day")), table, 2)
    store.fold(spark, table, "2025-05-01")
    asked = _dense(spark).where("corridor_id IN ('c007', 'c008') AND congestion_index % 12 = 0")
    keys = asked.select("corridor_id", "event_time").unionByName(
        spark.createDataFrame([("nowhere", None), (None, None), ("c900", None)], "corridor_id string, event_time timestamp")
    )
    found = store.lookup(spark, table, keys)
    got = rows(found, "corridor_id", "congestion_index", "speed_kmh")
    want = rows(lookup_metric(store.read_table(spark, table), keys), "corridor_id", "congestion_index", "speed_kmh")
    assert got == want and 60 < len(got) < 140
    found.collect()
    assert 0 < _scanned(found) < DAY_ROWS / 20
    # more keys than are named: a join, with the same rows
    many = _dense(spark).where("congestion_index % 50 = 0").select("corridor_id", "event_time")
    joined = store.lookup(spark, table, many)
    assert joined.count() == many.count() > store.NAMED_KEYS
    assert store.lookup(spark, table, keys.limit(0)).count() == 0


def _land(spark, path, data, minutes_old, now):
    """One file of (partition, offset, minute) messages, landed so many minutes before ``now``."""
    before = set(os.listdir(path)) if os.path.isdir(path) else set()
    df = spark.createDataFrame(data, "partition int, offset long, minute int").select(
        "partition", "offset", (F.lit(now) - F.make_dt_interval(mins=F.col("minute"))).alias("timestamp")
    )
    df.coalesce(1).write.mode("append").parquet(path)
    for name in set(os.listdir(path)) - before:
        at = (now - timedelta(minutes=minutes_old)).timestamp()
        os.utime(f"{path}/{name}", (at, at))


def _check(spark, envelopes, now):
    seen = envelopes.select(F.lit("traffic_events").alias("topic"), "partition", "offset", "timestamp")
    topics = reference.topic_names(spark, ["traffic_events"], ["traffic_events"])
    return rows(feed_freshness(seen, topics, now), "topic", "newest", "age_minutes", "status")


def test_a_check_reads_the_tail_of_a_feed(spark, home):
    path = f"{home}/feed".removeprefix("file://")
    source = FeedSource(format="parquet", path=path)
    now = datetime.now(timezone.utc).replace(microsecond=0)
    for hours in range(48, 2, -1):
        data = [(0, 100 - hours, 60 * hours + 1), (1, 100 - hours, 60 * hours + 2)]
        _land(spark, path, data, 60 * hours, now)
    whole = feeds.load_feed(spark, "traffic", source)
    stale = feeds.load_tail(spark, "traffic", source, now)
    assert _check(spark, stale, now) == _check(spark, whole, now)
    assert len(stale.inputFiles()) < 20 < len(whole.inputFiles())
    # the newest message is not the last of its partition: an older one came after it
    _land(spark, path, [(0, 500, 3), (0, 501, 9), (1, 500, 5)], 2, now)
    whole = feeds.load_feed(spark, "traffic", source)
    fresh = feeds.load_tail(spark, "traffic", source, now)
    assert len(fresh.inputFiles()) == 1
    assert _check(spark, fresh, now) == _check(spark, whole, now)
    assert _check(spark, fresh, now)[0][2:] == (5.0, "healthy")


def test_the_tail_of_an_empty_feed_is_empty(spark, home):
    path = f"{home}/feed".removeprefix("file://")
    now = datetime.now(timezone.utc)
    _land(spark, path, [], 5, now)
    assert feeds.load_tail(spark, "traffic", FeedSource(format="parquet", path=path), now).count() == 0


def test_a_broker_is_asked_from_a_time_on(spark, monkeypatch):
    asked = []

    def fake(spark_, kind, source):
        asked.append(source.options)
        moments = [(datetime(2025, 1, 1, tzinfo=timezone.utc),)] if len(asked) == 3 else []
        return spark.createDataFrame(moments, "timestamp timestamp")

    monkeypatch.setattr(feeds, "load_feed", fake)
    feeds.load_tail(spark, "traffic", FeedSource(options={"kafka.bootstrap.servers": "x"}), "2025-01-01 10:00")
    spans = [1735725600000 - int(o["startingTimestamp"]) for o in asked]
    assert spans == [900_000, 7_200_000, 57_600_000]
    assert all(o["kafka.bootstrap.servers"] == "x" for o in asked)


def test_folded_rows_are_sorted_and_spread(spark, home):
    table = store.congestion_table(f"{home}/metrics")
    store.write_version(_dense(spark), table, 0)
    store.fold(spark, table, "2025-05-01")
    stored = store.read_table(spark, table)
    assert stored.count() == DAY_ROWS and "Sort [" not in plan(stored).split("== Physical Plan ==")[1]
