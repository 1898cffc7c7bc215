"""The ledger of versions, the audit of batches, and the table of newest rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows, with_times
from roadpulse.functions.times import moment
from roadpulse.sources.feeds import FeedSource
from roadpulse.streaming import files, jobs, newest, progress, records, store
from test_store import _speeds, _three_batches
from test_streaming import Traffic, _event, _land

SCHEMA = store.T.StructType([store.T.StructField("n", store.T.LongType())])


def test_records_replace_themselves_and_survive_packing(spark, home):
    at = moment("2025-01-01")
    assert records.read(spark, home, SCHEMA).count() == 0 and records.pack(spark, home, SCHEMA) == 0
    for name, n in (("a-1", 1), ("a-2", 2), ("a-1", 3)):
        records.write(spark, home, name, {"n": n}, at)
    assert rows(records.read(spark, home, SCHEMA), "n") == [(2,), (3,)]
    assert records.pack(spark, home, SCHEMA) == 2
    assert [n for n in files.children(spark, home) if n.endswith(".json")] == []
    assert rows(records.read(spark, home, SCHEMA), "n") == [(2,), (3,)]
    records.write(spark, home, "a-2", {"n": 9}, at + timedelta(hours=1))
    records.write(spark, home, "a-3", {"n": 4}, at)
    assert rows(records.read(spark, home, SCHEMA), "n") == [(3,), (4,), (9,)]
    assert rows(records.read(spark, home, SCHEMA, above="a-1"), "n") == [(4,), (9,)]
    assert records.pack(spark, home, SCHEMA) == 2 and len(files.children(spark, home)) == 1
    assert rows(records.read(spark, home, SCHEMA), "n") == [(3,), (4,), (9,)]
    assert rows(records.read(spark, home, SCHEMA, above="a-2"), "n") == [(4,)]


def test_audit_and_retention_read_no_data(spark, home, monkeypatch):
    table = store.vehicle_table(home)
    _three_batches(spark, table)
    old = _speeds(spark, [("a", "2024-01-01 00:05", 1.0, True), ("a", "2024-01-02 00:05", 1.0, True)])
    store.write_version(old, table, 6, written_at="2024-01-03")
    store.fold(spark, table, "2024-01-02")
    store.pack_ledger(spark, table)
    for n in range(2):
        # data that can no longer be read
        for day in files.children(spark, table.path, "event_date="):
            for version in files.children(spark, f"{table.path}/{day}"):
                for part in files.children(spark, f"{table.path}/{day}/{version}", "part-"):
                    files.write_text(spark, f"{table.path}/{day}/{version}/{part}", "damaged")
        assert rows(store.lasting_audit(spark, table), "*") == [(0, 3), (1, 3), (2, 3), (3, 2)]
        # the fold has rows written just now, only version 6 of January 2nd is old
        assert store.drop_expired(spark, table, "2024-03-01") == 1 - n
    assert not files.exists(spark, f"{table.path}/event_date=2024-01-02")
    assert rows(store.lasting_audit(spark, table), "*") == [(0, 3), (1, 3), (2, 3), (3, 2)]


def test_a_table_without_ledger_gets_one(spark, home, monkeypatch):
    table = store.vehicle_table(home)
    _three_batches(spark, table)
    want = rows(store.read_ledger(spark, table), "version", "rows_written", "dates")
    files.delete(spark, table.ledger)
    assert store.complete_ledger(spark, table) == 3 and store.complete_ledger(spark, table) == 0
    assert rows(store.read_ledger(spark, table), "version", "rows_written", "dates") == want
    # a fold that dies before it is recorded
    original = store.complete_ledger
    calls = []

    def once(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("driver lost")
        return original(*args)

    with monkeypatch.context() as patch:
        patch.setattr(store, "complete_ledger", once)
        with pytest.raises(OSError):
            store.fold(spark, table, "2024-01-05")
    assert store.complete_ledger(spark, table) == 1
    folds = store.read_ledger(spark, table).where("version % 2 = 1")
    assert rows(folds, "version", "rows_written") == [(5, 4)]


def test_newest_rows_follow_the_log(spark, home):
    rnd = random.Random(8)
    table = store.vehicle_table(home)
    for n in range(7):
        data = [(f"c{rnd.randrange(4)}", f"2024-01-{rnd.randint(1, 9):02d} 00:05", rnd.random(), True) for _ in range(5)]
        data = list({d[:2]: d for d in data}.values())
        for _ in range(1 + n % 2):  # every other batch is replayed
            store.write_version(_speeds(spark, data), table, 2 * n)
            if n != 3:  # one batch died before it was merged
                store.advance_newest(spark, table, 2 * n)
        by_log = store.latest_by(store.read_log(spark, table), ["corridor_id"], ["event_time", "version"])
        want = rows(with_times(by_log, "event_time"), "corridor_id", "event_time", "avg_speed_kmh")
        got = with_times(store.read_newest(spark, table, "corridor_id"), "event_time")
        assert rows(got, "corridor_id", "event_time", "avg_speed_kmh") == want
        if n == 4:
            store.fold(spark, table, "2024-01-06")
            store.pack_ledger(spark, table)
    assert len(newest.versions(spark, f"{table.path}.newest")) == 2


def test_a_silent_entity_costs_one_small_table(spark, home, monkeypatch):
    table = store.vehicle_table(home)
    for n in range(9):
        store.write_version(_speeds(spark, [("a", f"2024-01-0{n + 1} 00:05", float(n), True)]), table, 2 * n)
        store.advance_newest(spark, table, 2 * n)
    read, original = [], store.read_log
    monkeypatch.setattr(store, "read_log", lambda s, t, days=None, above=None: read.append(days) or original(s, t, days, above))
    known = spark.createDataFrame([("a",), ("silent",)], "corridor_id string")
    assert rows(store.read_newest(spark, table, "corridor_id", known=known), "avg_speed_kmh") == [(8.0,)]
    assert read == [[]]


def test_an_expired_newest_row_gives_way_to_a_later_write(spark, home):
    table = store.vehicle_table(home)
    ahead = _speeds(spark, [("a", "2024-06-01 00:05", 1.0, True), ("b", "2024-01-01 00:05", 3.0, True)])
    store.write_version(ahead, table, 0, written_at="2024-01-01")
    store.write_version(_speeds(spark, [("a", "2024-02-01 00:05", 2.0, True)]), table, 2, written_at="2024-02-10")
    for version in (0, 2):
        store.advance_newest(spark, table, version)
    assert rows(store.read_newest(spark, table, "corridor_id"), "avg_speed_kmh") == [(1.0,), (3.0,)]
    assert rows(store.read_newest(spark, table, "corridor_id", "2024-02-20"), "avg_speed_kmh") == [(2.0,)]


def test_batches_are_audited_with_late_keys(spark, home):
    job = Traffic(spark, home)

    def run():
        audit = progress.BatchAudit(spark, progress.batches_folder(job.table.path))
        job.run(audit=audit)
        assert audit.wait()
        got = progress.read_batches(spark, job.table.path).where("rows_read > 0")
        return rows(got, "batch_id", "rows_read", "rows_written", "late_keys")

    _land(spark, job.feed, [_event(1), _event(2), _event(1, corridor="july26")])
    assert run() == [(0, 3, 2, 0)]
    _land(spark, job.feed, [_event(95)], 10)
    second = run()
    assert second[0] == (0, 3, 2, 0) and second[1][1:] == (1, 1, 0)
    _land(spark, job.feed, [_event(3), _event(4), _event(12, corridor="july26"), _event(96)], 20)
    third = run()
    assert third[:2] == second and third[2][1:] == (4, 1, 2)  # two windows came too late
    stored = store.lasting_audit(spark, job.table)
    assert sorted(r[1] for r in rows(stored, "*")) == [1, 1, 2]


def test_a_failed_run_replaces_its_record(spark, home, monkeypatch):
    job = Traffic(spark, home)
    _land(spark, job.feed, [_event(1)])
    folder = progress.batches_folder(job.table.path)
    records.write(spark, folder, "batch-000000000000", {"batch_id": 0, "rows_read": 77, "rows_written": 5, "late_keys": 0}, moment("2020-01-01"))
    audit = progress.BatchAudit(spark, folder)
    job.run(audit=audit)
    audit.wait()
    assert rows(progress.read_batches(spark, job.table.path).where("batch_id = 0"), "rows_read") == [(1,)]


def _ping(second, vehicle, speed, offset=0):
    at = (datetime(2025, 5, 5) + timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"vehicle_id": vehicle, "corridor_id": "a", "speed_kmh": speed, "event_time": at}


def test_vehicle_snapshot_job_equals_the_batch_after_every_slice(spark, home):
    source = FeedSource(format="json", path=f"{home}/feed")
    slices = [
        [_ping(0, "v1", 1.0), _ping(1, "v2", 2.0), _ping(1, "v2", 3.0), {"corridor_id": "a"}],
        [_ping(50, "v1", 4.0)],
        [_ping(2, "v2", 5.0), _ping(49, "v1", 6.0)],  # late, and still v2's latest
        [_ping(300, "v3", 7.0)],
    ]
    folder, first = f"{home}/snapshot", 0
    for n, slice_ in enumerate(slices):
        _land(spark, source.path, slice_, first)
        first += len(slice_)
        jobs.start_vehicle_snapshot(spark, source, folder, f"{home}/checkpoint", {"availableNow": True}).awaitTermination()
        feed = jobs.decode_feed(spark.read.schema(jobs.schemas.ENVELOPE).json(source.path), "vehicle", ("offset",))
        for as_of in ("2025-05-05 00:00:50", "2025-05-05 00:01:50", "2025-05-05 00:01:51", "2025-05-05 00:07:00"):
            want = jobs.vehicle_snapshot(feed.where("vehicle_id IS NOT NULL"), as_of, tie_breaks=("offset",))
            got = jobs.live_snapshot(spark, folder, as_of)
            assert rows(got, "vehicle_id", "speed_kmh", "offset") == rows(want, "vehicle_id", "speed_kmh", "offset")
        counts = [jobs.live_snapshot(spark, folder, f"2025-05-05 00:01:5{s}").count() for s in (0, 1)]
        assert counts[1] == (0 if n in (1, 2) else counts[0])
    plan = jobs.live_snapshot(spark, folder, "2025-05-05")._jdf.queryExecution().toString()
    assert "Python" not in plan and "feed" not in plan
    assert len(newest.versions(spark, folder)) == 2
    assert jobs.live_snapshot(spark, f"{home}/none", "2025-05-05").count() == 0
    with pytest.raises(ValueError, match="checkpoint"):
        jobs.start_vehicle_snapshot(spark, source, folder, f"{home}/other", {"availableNow": True})


def test_rows_without_time_or_dates_do_not_break_the_ledger(spark, home):
    table = store.vehicle_table(home)
    store.write_version(_speeds(spark, [("a", None, 1.0, True)]).where(F.lit(False)), table, 0)
    assert rows(store.read_ledger(spark, table), "version", "rows_written", "dates") == [(0, 0, [])]
    assert store.lasting_audit(spark, table).count() == 0
