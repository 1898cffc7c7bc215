"""Baselines added up from parts of folded dates."""

import random

from pyspark.sql import functions as F

from helpers import rows
from roadpulse.operators.baselines import baseline_parts, baselines, baselines_of_parts
from roadpulse.plans import daily
from roadpulse.streaming import files, store

KEYS = ("corridor_id", "day_of_week", "hour_of_day", "avg_travel_time_sec", "sample_count")
NOW = "2025-03-20 09:30:00"


def _metrics(spark, seed=1, days=10, value=lambda rnd: rnd.random() * 2):
    rnd = random.Random(seed)
    data = []
    for n in range(days * 48):
        at = f"2025-03-{20 - n // 48:02d} {n % 24:02d}:{10 * (n // 24 % 6):02d}:00"
        index = None if rnd.random() < 0.05 else value(rnd)
        data.append((rnd.choice(["a", "b", "unlisted"]), at, 0, 0, index, None if rnd.random() < 0.05 else 30.0, False))
    data = list({r[:2]: r for r in data}.values())
    schema = "corridor_id string, event_time string, travel_time_sec int, free_flow_sec int, congestion_index double, speed_kmh double, is_anomaly boolean"
    df = spark.createDataFrame(data, schema)
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def _corridors(spark):
    return spark.createDataFrame([("a",), ("b",), ("silent",)], "corridor_id string")


def test_parts_of_any_division_give_the_same_mean(spark):
    for value in (
        lambda rnd: rnd.random() * 2,
        lambda rnd: rnd.choice([0.1, 5e5, 1e15, 0.123456789]),
        lambda rnd: rnd.choice([0.5, float("nan"), float("inf")]),
        lambda rnd: rnd.choice([0.25, 2e21]),
    ):
        metrics = _metrics(spark, value=value)
        want = rows(baselines(metrics, _corridors(spark), NOW), *KEYS)
        recent = metrics.where(F.col("event_time") >= F.lit("2025-03-13 09:30:00").cast("timestamp"))
        split = baseline_parts(recent.withColumn("salt", F.pmod(F.xxhash64("event_time"), F.lit(7))), "salt")
        got = rows(baselines_of_parts(split.drop("salt"), _corridors(spark), NOW), *KEYS)
        assert repr(got) == repr(want) and len(want) > 90


def test_stored_baselines_read_parts_of_folded_dates(spark, home, monkeypatch):
    table = store.congestion_table(f"{home}/metrics")
    metrics = _metrics(spark)
    for n in range(3):
        part = metrics.where(F.pmod(F.xxhash64("event_time"), F.lit(3)) == n)
        store.write_version(part, table, 2 * n, NOW)
    want = rows(baselines(metrics, _corridors(spark), NOW), *KEYS)

    def got():
        return rows(daily.stored_baselines(spark, table, _corridors(spark), NOW), *KEYS)

    assert got() == want
    store.fold(spark, table, "2025-03-19")
    assert got() == want  # no parts yet
    assert daily.add_baseline_parts(spark, table) == 8 and daily.add_baseline_parts(spark, table) == 0
    read, original = [], store.read_table

    def listed(*args, **kwargs):
        read.append(kwargs.get("days"))
        return original(*args, **kwargs)

    monkeypatch.setattr(store, "read_table", listed)
    # rows of the date the seven days begin in, of yesterday and of today
    assert got() == want and read == [["2025-03-13", "2025-03-19", "2025-03-20"]]
    # a folded date that is written to again counts by its rows, until it is folded again
    late = metrics.where("event_time >= '2025-03-15' AND event_time < '2025-03-16'").withColumn("congestion_index", F.lit(7.0))
    store.write_version(late, table, 6, NOW)
    after = metrics.withColumn(
        "congestion_index",
        F.when(F.to_date("event_time") == F.lit("2025-03-15").cast("date"), 7.0).otherwise(F.col("congestion_index")),
    )
    want = rows(baselines(after, _corridors(spark), NOW), *KEYS)
    assert got() == want and "2025-03-15" in read[-1]
    store.fold(spark, table, "2025-03-19")
    assert got() == want and "2025-03-15" in read[-1]
    assert daily.add_baseline_parts(spark, table) == 1
    assert got() == want and "2025-03-15" not in read[-1]
    assert files.children(spark, f"{table.path}.baseline_parts/event_date=2025-03-15") == ["version=7"]


def test_parts_with_rows_past_retention_do_not_count(spark, home):
    table = store.congestion_table(f"{home}/metrics")
    metrics = _metrics(spark)
    old = metrics.where("corridor_id = 'a'")
    store.write_version(old, table, 0, "2025-02-01")
    store.write_version(metrics.where("corridor_id = 'b'"), table, 2, NOW)
    store.fold(spark, table, "2025-03-19")
    daily.add_baseline_parts(spark, table)
    want = rows(baselines(metrics.where("corridor_id = 'b'"), _corridors(spark), NOW), *KEYS)
    assert rows(daily.stored_baselines(spark, table, _corridors(spark), NOW), *KEYS) == want
    store.drop_expired(spark, table, "2025-09-01")
    assert daily.add_baseline_parts(spark, table) == 0
    assert files.children(spark, f"{table.path}.baseline_parts", "event_date=") == []
    assert daily.stored_baselines(spark, table, _corridors(spark), NOW).count() == 0
