"""Streaming jobs over landed files: same result as batch, recovery, late rows, alerts."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows, with_times
from roadpulse.operators import alerts as al
from roadpulse.operators.quality import reconcile
from roadpulse.operators.traffic import traffic_windows
from roadpulse.sources.feeds import FeedSource, decode_feed
from roadpulse.streaming import files, jobs, store
from roadpulse.streaming.sinks import AlertChannel, alert_sink, upsert_sink

NOW = "2026-01-02 00:00:00"
BASE = datetime(2026, 1, 1)


def _event(minute, index=0.5, speed=30.0, corridor="ring_road"):
    moment = (BASE + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"corridor_id": corridor, "congestion_index": index, "speed_kmh": speed, "event_time": moment}


def _land(spark, path, events, first=0):
    data = [(json.dumps(e), first + i) for i, e in enumerate(events)]
    df = spark.createDataFrame(data, "value string, offset long")
    df.coalesce(1).write.mode("append").json(path)


class Traffic:
    """One traffic job with its folders."""

    def __init__(self, spark, home, alerts=False):
        self.spark, self.home = spark, home
        self.feed = f"{home}/feed"
        self.table = store.congestion_table(f"{home}/metrics")
        self.log = store.alert_table(f"{home}/alerts") if alerts else None
        self.channel = AlertChannel(path=f"{home}/messages") if alerts else None

    def run(self, **more):
        query = jobs.start_traffic(
            self.spark, FeedSource(format="json", path=self.feed), self.table, f"{self.home}/checkpoint",
            alerts=self.log, channel=self.channel, trigger={"availableNow": True}, now=NOW, **more,
        )
        query.awaitTermination()
        return query

    def state(self):
        return store.read_table(self.spark, self.table)

    def values(self):
        shown = with_times(self.state(), "event_time")
        return rows(shown, "corridor_id", "event_time", "congestion_index")


def test_stream_equals_batch_over_restarts(spark, home):
    job = Traffic(spark, home)
    events = [_event(m, (m * 7 % 20) / 10, 10 + m % 30, f"c{m % 3}") for m in range(0, 240)]
    written = 0
    for start in range(0, 240, 65):  # cuts inside windows
        _land(spark, job.feed, events[start : start + 65], start)
        progress = job.run(files_per_batch=2).recentProgress
        written += sum(p["observedMetrics"]["batch"]["rows"] for p in progress if p["observedMetrics"])
    batch = traffic_windows(
        decode_feed(spark.createDataFrame([(json.dumps(e),) for e in events], "value string"), "traffic")
    )
    result = reconcile(batch, job.state(), ["corridor_id", "event_time"], tolerance=0.0)
    assert result.count() == 3 * 24
    assert result.where("not matched").count() == 0
    audit = store.batch_audit(store.read_log(spark, job.table))
    stored = audit.agg(F.sum("rows_written")).first()[0]
    assert stored > 3 * 24  # cut windows were written twice
    assert written == stored


def test_late_rows(spark, home):
    """A late row still counts one batch behind the watermark, and no longer two behind."""
    soon, later = Traffic(spark, f"{home}/soon"), Traffic(spark, f"{home}/later")
    one = FeedSource(format="json", path="", options={"maxFilesPerTrigger": "1"})

    def run(job, slices):
        for events in slices:
            _land(spark, job.feed, events)
        query = jobs.start_traffic(
            spark, FeedSource(format="json", path=job.feed, options=one.options), job.table,
            f"{job.home}/checkpoint", trigger={"availableNow": True}, now=NOW,
        )
        query.awaitTermination()
        return [v for v in job.values() if v[1] == "2026-01-01 00:10:00"]

    first, ahead, late, more = [_event(1, 0.2)], [_event(30, 0.2)], [_event(2, 0.4)], [_event(31, 0.2)]
    assert run(soon, [first, ahead, late]) == [("ring_road", "2026-01-01 00:10:00", 0.3)]
    assert run(later, [first, ahead, more, late]) == [("ring_road", "2026-01-01 00:10:00", 0.2)]


def test_failed_batch_is_replayed(spark, home, monkeypatch):
    job = Traffic(spark, home)
    _land(spark, job.feed, [_event(m, 0.4) for m in range(20)])
    job.run()
    _land(spark, job.feed, [_event(m, 0.8) for m in range(18, 40)], 100)
    original = jobs.upsert_sink

    def failing(*args, **kwargs):
        sink = original(*args, **kwargs)

        def write(batch, batch_id):
            sink(batch, batch_id)
            raise RuntimeError("lost after writing")

        return write

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "upsert_sink", failing)
        with pytest.raises(Exception, match="lost after writing"):
            job.run()
    assert store.read_log(spark, job.table).count() > 0
    job.run()
    values = job.values()
    assert values[0] == ("ring_road", "2026-01-01 00:10:00", 0.4)
    assert values[1] == ("ring_road", "2026-01-01 00:20:00", 5.6 / 12)
    assert [v[2] for v in values[2:]] == [0.8, 0.8]


def test_table_and_checkpoint_belong_together(spark, home):
    job = Traffic(spark, home)
    _land(spark, job.feed, [_event(1)])
    job.run()
    with pytest.raises(ValueError, match="checkpoint"):
        jobs.start_traffic(
            spark, FeedSource(format="json", path=job.feed), job.table, f"{home}/other",
            trigger={"availableNow": True},
        )


def test_alerts_repeat_per_update_and_reach_the_channel(spark, home):
    job = Traffic(spark, home, alerts=True)
    _land(spark, job.feed, [_event(1, 0.9), _event(1, 0.1, 50.0, "july26")])
    job.run()
    _land(spark, job.feed, [_event(2, 1.1), _event(12, 0.8)], 10)
    job.run()
    log = store.read_log(spark, job.log)
    assert rows(with_times(log, "event_time"), "corridor_id", "event_time", "congestion_index") == [
        ("ring_road", "2026-01-01 00:10:00", 0.9),
        ("ring_road", "2026-01-01 00:10:00", 1.0),
        ("ring_road", "2026-01-01 00:20:00", 0.8),
    ]
    latest = al.latest_alerts(log, ("created_at", "version"))
    assert rows(latest, "congestion_index") == [(0.8,), (1.0,)]
    messages = spark.read.json(f"{home}/messages")
    sent = [json.loads(r.value) for r in messages.where("key = 'ring_road'").collect()]
    assert sorted(m["message"] for m in sent) == sorted(log.toPandas()["message"])
    assert {m["created_at"] for m in sent} == {"2026-01-02T00:00:00Z"}


def _batch(spark):
    return spark.createDataFrame(
        [("a", 0.9, 10.0, True)], "corridor_id string, congestion_index double, speed_kmh double, is_anomaly boolean"
    ).withColumns({
        "event_time": F.lit("2026-01-01 00:10:00").cast("timestamp"),
        "travel_time_sec": F.lit(0), "free_flow_sec": F.lit(0),
    })


def test_a_replayed_batch_replaces_its_alerts(spark, home):
    log = store.alert_table(f"{home}/alerts")
    sink = alert_sink(log, AlertChannel(path=f"{home}/messages"))
    sink(_batch(spark), 4)
    sink(_batch(spark), 4)
    logged = rows(al.alert_messages(store.read_log(spark, log).select(*log.columns.names)), "key", "value")
    assert logged == rows(spark.read.json(f"{home}/messages"), "key", "value")
    assert len(logged) == 1


def test_a_failed_log_fails_the_batch_and_a_failed_channel_does_not(spark, home, monkeypatch):
    table = store.congestion_table(f"{home}/metrics")
    log = store.alert_table(f"{home}/alerts")

    class Broken(AlertChannel):
        def send(self, messages, batch_id):
            raise OSError("channel down")

    sink = upsert_sink(table, alert_sink(log, Broken(), NOW))
    sink(_batch(spark), 0)
    assert store.read_log(spark, table).count() == store.read_log(spark, log).count() == 1

    sent = []

    class Recorder(AlertChannel):
        def send(self, messages, batch_id):
            sent.append(batch_id)

    bad_log = store.alert_table("nofs://nowhere/alerts")
    with pytest.raises(Exception):
        upsert_sink(table, alert_sink(bad_log, Recorder(), NOW))(_batch(spark), 1)
    assert sent == []  # nothing sent without the log
    upsert_sink(table, alert_sink(log, Recorder(), NOW))(_batch(spark), 1)  # the batch again
    assert sent == [1]
    assert store.read_log(spark, table).count() == store.read_log(spark, log).count() == 2


def test_metric_failures_fail_the_batch(spark):
    with pytest.raises(Exception):
        upsert_sink(store.congestion_table("nofs://nowhere/metrics"))(_batch(spark), 0)


def test_empty_batches_write_nothing(spark, home):
    table = store.congestion_table(f"{home}/metrics")
    log = store.alert_table(f"{home}/alerts")
    empty = _batch(spark).where("false")
    upsert_sink(table, alert_sink(log, None, NOW), files_per_batch=2)(empty, 0)
    assert not files.has_children(spark, table.path, "event_date=")
    assert store.read_table(spark, table).count() == 0


def test_weather_stream_drops_nothing_late_and_collapses(spark, home):
    def report(minute, temperature, location="Cairo"):
        text = (BASE + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M")
        return {"location": location, "event_time": text, "temperature_c": temperature}

    table = store.weather_table(f"{home}/metrics")
    for first, events in ((0, [report(600, 1.0), report(600, 2.0)]), (10, [report(0, 3.0), report(600, 4.0)]),
                          (20, [report(1, 5.0, None), {"location": "Cairo", "event_time": "bad"}])):
        _land(spark, f"{home}/feed", events, first)
        jobs.start_weather(
            spark, FeedSource(format="json", path=f"{home}/feed"), table, f"{home}/checkpoint",
            trigger={"availableNow": True}, now=NOW,
        ).awaitTermination()
    shown = with_times(store.read_table(spark, table), "event_time")
    assert rows(shown, "event_time", "temperature_c") == [
        ("2026-01-01 00:00:00", 3.0),
        ("2026-01-01 10:00:00", 4.0),
    ]


def test_vehicle_stream(spark, home):
    table = store.vehicle_table(f"{home}/metrics")
    pings = [{"corridor_id": "a", "speed_kmh": s, "event_time": f"2026-01-01T00:0{m}:00Z"} for m, s in ((1, 10), (4, 20), (5, 40))]
    _land(spark, f"{home}/feed", pings)
    jobs.start_vehicles(
        spark, FeedSource(format="json", path=f"{home}/feed"), table, f"{home}/checkpoint",
        trigger={"availableNow": True}, now=NOW,
    ).awaitTermination()
    shown = with_times(store.read_table(spark, table), "event_time")
    assert rows(shown, "event_time", "avg_speed_kmh", "is_anomaly") == [
        ("2026-01-01 00:05:00", 15.0, True),
        ("2026-01-01 00:10:00", 40.0, False),
    ]
