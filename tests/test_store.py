import pytest
from pyspark.sql import functions as F

from helpers import plan, rows, with_times
from roadpulse import schemas
from roadpulse.streaming import files, store


def _speeds(spark, data):
    df = spark.createDataFrame(data, "corridor_id string, event_time string, avg_speed_kmh double, is_anomaly boolean")
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def _state(spark, table):
    return rows(with_times(store.read_table(spark, table), "event_time"), "corridor_id", "event_time", "avg_speed_kmh")


def test_last_write_wins_and_replay_replaces(spark, home):
    table = store.vehicle_table(home)
    assert store.read_table(spark, table).count() == 0
    first = _speeds(spark, [("a", "2024-01-01 00:05", 10.0, True), ("b", "2024-01-01 00:05", 20.0, False)])
    second = _speeds(spark, [("a", "2024-01-01 00:05", 11.0, True), ("a", "2024-01-02 00:05", 12.0, True)])
    store.write_version(first, table, 0)
    store.write_version(second, table, 2)
    want = [("a", "2024-01-01 00:05:00", 11.0), ("a", "2024-01-02 00:05:00", 12.0), ("b", "2024-01-01 00:05:00", 20.0)]
    assert _state(spark, table) == want
    store.write_version(second, table, 2)
    store.write_version(first, table, 0)  # an old batch replayed late does not win
    assert _state(spark, table) == want
    assert store.read_log(spark, table).count() == 4
    assert rows(store.batch_audit(store.read_log(spark, table)), "*") == [(0, 2), (1, 2)]
    recent = store.read_table(spark, table, since="2024-01-01 12:00")
    assert recent.count() == 1


def test_offset_breaks_ties_within_a_batch(spark, home):
    table = store.weather_table(home)
    df = spark.createDataFrame(
        [("Cairo", 1, 10.0), ("Cairo", 3, 30.0), ("Cairo", 2, 20.0)],
        "location string, offset long, temperature_c double",
    ).withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))
    for name in schemas.WEATHER_METRICS.names:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(schemas.WEATHER_METRICS[name].dataType))
    store.write_version(df, table, 0)
    assert rows(store.read_table(spark, table), "location", "temperature_c") == [("Cairo", 30.0)]


def _three_batches(spark, table):
    for batch, speed in enumerate((10.0, 11.0, 12.0)):
        data = [("a", "2024-01-01 00:05", speed, True), (f"only{batch}", "2024-01-01 00:05", speed, True),
                ("a", "2024-01-09 00:05", speed, True)]
        store.write_version(_speeds(spark, data), table, store.batch_version(batch))


def test_folded_dates_are_read_without_a_shuffle(spark, home):
    table = store.vehicle_table(home)
    _three_batches(spark, table)
    before = _state(spark, table)
    assert "partial_max_by" in plan(store.read_table(spark, table))
    store.fold(spark, table, "2024-01-20")
    assert _state(spark, table) == before
    closed = store.read_table(spark, table, since="2024-01-01")
    physical = plan(closed).split("== Physical Plan ==")[1]
    folds, still_open = physical.split("FileScan")[1:3]
    assert "Exchange" not in physical.split("FileScan")[0]
    assert "PartitionFilters: [" in folds and "NOT" in still_open
    # a date that was folded and then written again is open again
    store.write_version(_speeds(spark, [("a", "2024-01-09 00:05", 50.0, True)]), table, 6)
    assert ("a", "2024-01-09 00:05:00", 50.0) in _state(spark, table)
    assert len(_state(spark, table)) == len(before)


def _versions(spark, table, day):
    return [int(v.split("=")[1]) for v in files.children(spark, f"{table.path}/event_date={day}", "version=")]


def test_fold_keeps_the_state(spark, home):
    table = store.vehicle_table(home)
    _three_batches(spark, table)
    before = _state(spark, table)
    assert store.fold(spark, table, "2024-01-05") == 1
    assert _versions(spark, table, "2024-01-01") == [5]
    assert _versions(spark, table, "2024-01-09") == [0, 2, 4]
    assert _state(spark, table) == before
    assert store.fold(spark, table, "2024-01-05") == 0
    # a later batch still wins over the fold
    store.write_version(_speeds(spark, [("a", "2024-01-01 00:05", 99.0, True)]), table, store.batch_version(3))
    assert ("a", "2024-01-01 00:05:00", 99.0) in _state(spark, table)
    assert store.fold(spark, table, "2024-01-05") == 1
    assert _versions(spark, table, "2024-01-01") == [7]
    assert ("a", "2024-01-01 00:05:00", 99.0) in _state(spark, table)


def test_a_fold_that_dies_before_cleaning_up_is_finished_later(spark, home, monkeypatch):
    table = store.vehicle_table(home)
    _three_batches(spark, table)
    before = _state(spark, table)

    def broken(*_):
        raise OSError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(store.files, "delete", broken)
        with pytest.raises(OSError):
            store.fold(spark, table, "2024-01-05")
    assert _state(spark, table) == before
    assert _versions(spark, table, "2024-01-01") == [0, 2, 4, 5]
    store.fold(spark, table, "2024-01-05")
    assert _versions(spark, table, "2024-01-01") == [5]
    assert _state(spark, table) == before


def test_retention_drops_whole_versions(spark, home):
    table = store.vehicle_table(home)
    old = _speeds(spark, [("a", "2024-01-01 00:05", 10.0, True), ("b", "2024-01-01 00:05", 10.0, True)])
    new = _speeds(spark, [("a", "2024-01-01 00:05", 11.0, True)])
    store.write_version(old, table, 0, written_at="2024-01-01")
    store.write_version(new, table, 2, written_at="2024-01-10")
    assert store.read_table(spark, table, live_at="2024-01-30").count() == 2
    live = store.read_table(spark, table, live_at="2024-02-05")
    assert rows(live, "corridor_id", "avg_speed_kmh") == [("a", 11.0)]
    assert store.read_newest(spark, table, "corridor_id", live_at="2024-02-05").count() == 1
    assert store.drop_expired(spark, table, "2024-01-30") == 0
    assert store.drop_expired(spark, table, "2024-02-05") == 1
    assert _versions(spark, table, "2024-01-01") == [2]
    assert store.drop_expired(spark, table, "2024-03-05") == 1
    assert files.children(spark, table.path, "event_date=") == []
    assert store.read_table(spark, table).count() == 0


def test_newest_rows_and_day(spark, home):
    table = store.vehicle_table(home)
    assert store.read_newest_day(spark, table).count() == 0
    _three_batches(spark, table)
    newest = with_times(store.read_newest(spark, table, "corridor_id"), "event_time")
    assert rows(newest, "corridor_id", "event_time", "avg_speed_kmh") == [
        ("a", "2024-01-09 00:05:00", 12.0), ("only0", "2024-01-01 00:05:00", 10.0),
        ("only1", "2024-01-01 00:05:00", 11.0), ("only2", "2024-01-01 00:05:00", 12.0),
    ]
    day = store.read_newest_day(spark, table)
    assert rows(day.select("event_date").distinct().withColumn("event_date", F.col("event_date").cast("string")), "*") == [
        ("2024-01-09",)
    ]


def test_newest_rows_of_known_entities_read_only_the_dates_they_need(spark, home, monkeypatch):
    table = store.vehicle_table(home)
    for n, day in enumerate(["2024-01-01", "2024-01-05", "2024-01-08", "2024-01-09"]):
        late = [("a", f"{day} 00:05", float(n), True)] + [("b", f"{day} 00:05", float(n), True)] * (n == 2)
        store.write_version(_speeds(spark, late + [("old", f"{day} 00:05", 1.0, True)] * (n == 0)), table, 2 * n)
    read, original = [], store.read_log

    def listed(spark, table, days=None):
        read.append(days)
        return original(spark, table, days)

    monkeypatch.setattr(store, "read_log", listed)

    def newest(*known):
        read.clear()
        frame = spark.createDataFrame([(k,) for k in known], "corridor_id string")
        return rows(store.read_newest(spark, table, "corridor_id", known=frame), "corridor_id", "avg_speed_kmh")

    assert newest("a") == [("a", 3.0)] and read == [["2024-01-09"]]
    assert newest("a", "b", "b") == [("a", 3.0), ("b", 2.0)] and len(read) == 2
    assert newest("b", "never") == [("a", 3.0), ("b", 2.0), ("old", 1.0)] and len(read[-1]) == 4
    # dates that are folded are not read again
    assert store.fold(spark, table, "2024-01-09") == 3
    read.clear()
    assert store.fold(spark, table, "2024-01-09") == 0 and read == []


def test_snapshots(spark, home):
    schema = schemas.CONGESTION_BASELINES
    assert store.read_snapshot(spark, home, schema).count() == 0
    for n in (1, 2):
        current = store.read_snapshot(spark, home, schema)
        row = spark.createDataFrame([("a", 0, n, 1.0, None, 1, None)], schema)
        assert store.publish_snapshot(spark, current.unionByName(row), home) == n - 1
    assert store.read_snapshot(spark, home, schema).count() == 2
    # the last two stay
    last = store.read_snapshot(spark, home, schema)
    assert store.publish_snapshot(spark, last, home) == 2
    assert files.children(spark, home, "snapshot=") == ["snapshot=1", "snapshot=2"]
    # an unfinished snapshot is not read
    spark.range(1).write.parquet(f"{home}/snapshot=9")
    files.delete(spark, f"{home}/snapshot=9/_SUCCESS")
    assert store.read_snapshot(spark, home, schema).count() == 2


def test_audit_outlives_folding_and_retention(spark, home):
    table = store.vehicle_table(f"{home}/speeds")
    assert store.lasting_audit(spark, table).count() == 0
    _three_batches(spark, table)
    want = [(0, 3), (1, 3), (2, 3)]
    assert rows(store.lasting_audit(spark, table), "*") == want
    assert store.fold(spark, table, "2024-01-05") == 1
    assert rows(store.lasting_audit(spark, table), "*") == want
    # a fold that dies after counting counts again
    store._keep_counts(table, store.read_log(spark, table))
    assert rows(store.lasting_audit(spark, table), "*") == want
    store.drop_expired(spark, table, "2100-01-01")
    assert store.read_log(spark, table).count() == 0
    assert rows(store.lasting_audit(spark, table), "*") == want
