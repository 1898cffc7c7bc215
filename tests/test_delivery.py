"""Alerts on their way to a channel, the folded alert log, and its newest rows."""

import json

import pytest
from pyspark.sql import functions as F

import oracle_check
from helpers import rows
from roadpulse import cli
from roadpulse.operators.alerts import build_alerts, recent_alerts
from roadpulse.plans import catalog, oracle
from roadpulse.streaming import files, store
from roadpulse.streaming.outbox import AlertChannel, Outbox
from roadpulse.streaming.replay import FailingChannel
from roadpulse.streaming.sinks import alert_sink


def _windows(spark, data):
    df = spark.createDataFrame(data, "corridor_id string, event_time string, congestion_index double")
    return df.withColumns({
        "event_time": F.col("event_time").cast("timestamp"), "speed_kmh": F.lit(20.0), "is_anomaly": F.lit(True),
    })


def _batch(spark, n, day="2025-03-04"):
    return _windows(spark, [(f"c{i}", f"{day} 10:{10 * (n % 5)}:00", 1.0 + n) for i in range(2)])


def _sent(spark, path):
    found = spark.read.schema("version long, key string, value string").json(path).collect()
    return sorted((r["version"] // 2, r["key"], json.loads(r["value"])["congestion_index"]) for r in found)


def test_a_channel_that_fails_twice_gets_every_message_once(spark, home):
    log = store.alert_table(f"{home}/alerts")
    sink = alert_sink(log, FailingChannel(path=f"{home}/messages", failures=2), "2025-03-05")
    box = Outbox(log, AlertChannel(path=f"{home}/messages"))
    for n in range(2):
        sink(_batch(spark, n), n)
        assert not files.exists(spark, f"{home}/messages") and box.sent(spark) == -1
    assert box.pending(spark).count() == 4
    sink(_batch(spark, 2), 2)
    want = [(n, f"c{i}", 1.0 + n) for n in range(3) for i in range(2)]
    assert _sent(spark, f"{home}/messages") == want
    assert box.sent(spark) == 4 and box.pending(spark).isEmpty()
    # the batch again, as Spark repeats one that it has not committed
    sink(_batch(spark, 2), 2)
    assert _sent(spark, f"{home}/messages") == want
    # empty batches move the cursor without sending
    sink(_batch(spark, 3).where("false"), 3)
    assert _sent(spark, f"{home}/messages") == want and box.sent(spark) == 6
    assert len(files.children(spark, box.path)) == 1


def test_pending_alerts_are_read_from_their_dates_only(spark, home, monkeypatch):
    log = store.alert_table(f"{home}/alerts")
    for n in range(6):
        alert_sink(log, None, "2025-03-15")(_batch(spark, n, f"2025-03-{4 + n:02d}"), n)
    box = Outbox(log, AlertChannel(path=f"{home}/messages"))
    box._move(spark, 6)
    read, original = [], store.read_log
    monkeypatch.setattr(store, "read_log", lambda s, t, days=None, above=None: read.append(days) or original(s, t, days, above))
    assert box.pending(spark).count() == 4
    assert read == [["2025-03-08", "2025-03-09"]]
    store.pack_ledger(spark, log)
    assert box.pending(spark).count() == 4 and read[-1] == ["2025-03-08", "2025-03-09"]


def test_deliver_command(spark, home, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda *args: spark)
    tables = cli.Tables(f"{home}/tables")
    alert_sink(tables.alerts, None, "2025-03-05")(_batch(spark, 0), 0)
    base = ["--tables", f"{home}/tables", "deliver"]
    for _ in range(2):
        assert cli.main([*base, "--alert-path", f"{home}/messages"]) == 0
        assert len(_sent(spark, f"{home}/messages")) == 2
    with pytest.raises(SystemExit):
        cli.main(base)


def _logged(spark, log):
    return rows(store.read_log(spark, log), "version", "corridor_id", "congestion_index")


def test_folding_a_log_keeps_every_raise(spark, home, monkeypatch):
    log = store.alert_table(f"{home}/alerts")
    for n in range(4):
        store.write_version(build_alerts(_batch(spark, n % 2), "2025-03-05"), log, 2 * n, "2025-03-05")
    before = _logged(spark, log)
    assert len(before) == 8 and {r[0] for r in before} == {0, 2, 4, 6}
    with monkeypatch.context() as patch:
        patch.setattr(store.files, "delete", lambda *_: (_ for _ in ()).throw(OSError("executor lost")))
        with pytest.raises(OSError):
            store.fold(spark, log, "2025-03-10")
    folder = f"{log.path}/event_date=2025-03-04"
    assert len(files.children(spark, folder, "version=")) == 5
    assert _logged(spark, log) == before  # the half-folded date is not read twice
    store.fold(spark, log, "2025-03-10")
    assert files.children(spark, folder, "version=") == ["version=7"]
    assert _logged(spark, log) == before
    # a later raise of a folded date, and another fold
    store.write_version(build_alerts(_batch(spark, 9), "2025-03-06"), log, 8, "2025-03-06")
    assert len(_logged(spark, log)) == 10
    store.fold(spark, log, "2025-03-10")
    assert files.children(spark, folder, "version=") == ["version=9"] and len(_logged(spark, log)) == 10
    assert rows(store.lasting_audit(spark, log), "*") == [(n, 2) for n in range(5)]


def test_newest_alerts_read_two_dates_of_thirty(spark, home, monkeypatch):
    log = store.alert_table(f"{home}/alerts")
    for n in range(30):
        day = f"2025-03-{n + 1:02d}"
        store.write_version(build_alerts(_batch(spark, n, day), f"{day} 12:00"), log, 2 * n, f"{day} 12:00")
    everything = rows(recent_alerts(store.read_log(spark, log), 4), "corridor_id", "congestion_index")
    store.fold(spark, log, "2025-03-20")
    read, original = [], store.read_log
    monkeypatch.setattr(store, "read_log", lambda s, t, days=None, above=None: read.append(days) or original(s, t, days, above))
    newest = store.newest_log_rows(spark, log, 4)
    assert read == [["2025-03-29", "2025-03-30"]]
    assert rows(recent_alerts(newest, 4), "corridor_id", "congestion_index") == everything
    assert store.newest_log_rows(spark, log, 1000).count() == 60
    # an alert raised late for an old window is among the newest
    store.write_version(build_alerts(_batch(spark, 77, "2025-03-02"), "2025-04-01"), log, 60, "2025-04-01")
    assert rows(recent_alerts(store.newest_log_rows(spark, log, 2), 2), "congestion_index") == [(78.0,), (78.0,)]
    assert store.newest_log_rows(spark, store.alert_table(f"{home}/none"), 3).count() == 0


@pytest.mark.parametrize("jam_on, raised", [(None, 0), (28, 1), (20, 1)])
def test_delivery_is_told_when_no_batch_gets_through(spark, home, jam_on, raised):
    """Without alerts nothing is ever sent; those of the last batches meet the failures only."""
    data = [(n, f"2024-01-{n + 1:02d} 10:01:00", n % 2, 122.0 if n + 1 == jam_on else 1.0) for n in range(30)]
    events = spark.createDataFrame(data, "event_id long, ts string, user_id long, value double")
    events = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    events.coalesce(1).write.parquet(f"{home}/events")
    files.rename(spark, next(f"{home}/events/{n}" for n in files.children(spark, f"{home}/events", "part-")), f"{home}/events.parquet")
    want = oracle.oracle_sql()["alert_delivery"]
    got = catalog.queries()["alert_delivery"](spark, home)
    assert oracle_check.compare(got, oracle_check.connect(home), want) == []
    assert [r["times_sent"] for r in got.collect()] == [1] * raised


def test_catching_up_tries_as_often_as_asked(spark, home):
    log = store.alert_table(f"{home}/alerts")
    alert_sink(log, None, "2025-03-05")(_batch(spark, 0), 0)
    channel = FailingChannel(path=f"{home}/messages", failures=3)
    box = Outbox(log, channel)
    with pytest.raises(OSError):
        box.catch_up(spark, 2)
    assert channel.received(spark).isEmpty() and box.sent(spark) == -1
    box.catch_up(spark, 2)
    assert channel.received(spark).count() == 2 and box.sent(spark) == 0 and box.pending(spark).isEmpty()
