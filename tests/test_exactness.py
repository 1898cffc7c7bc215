"""Means of groups of any size, and results without caps."""

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from roadpulse import cli
from roadpulse.functions.numeric import fixed_text, steady_avg
from roadpulse.operators.merge import insert_if_absent, merge_by_key
from roadpulse.streaming import jobs, store


def test_a_mean_past_64_bits_is_the_same_on_any_number_of_partitions(spark):
    # the units of this group come to about 1.4e20, fifteen times 2^63
    values = spark.range(3_000_000).select((F.col("id") * 0.031 + 1e3).alias("x"))
    big = values.unionByName(values.select((F.col("x") * 1e6).alias("x")))
    for df in (values, big):
        means = {df.repartition(n).agg(steady_avg("x")).first()[0] for n in (1, 3, 8, 13)}
        assert len(means) == 1
    exact = 1e3 + 0.031 * (3_000_000 - 1) / 2
    assert values.agg(steady_avg("x")).first()[0] == pytest.approx(exact, rel=1e-12)


def test_a_group_of_many_rows_keeps_its_exact_mean(spark):
    many = spark.range(0, 400_000_000, 1, 8).select((30 + F.col("id") % 2).cast("double").alias("x"))
    assert many.agg(steady_avg("x")).first()[0] == 30.5


def test_means_of_special_values(spark):
    def mean(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(steady_avg("x")).first()[0]

    assert mean(None) is None and mean(-1.5, 1.5, None) == 0.0
    assert mean(-12345.678901, -0.000001) == -12345.678902 / 2
    assert mean(float("inf"), 1.0) == float("inf") and mean(float("nan"), 1.0) != mean(1.0)


def test_long_numbers_keep_fixed_decimals(spark):
    df = spark.createDataFrame([(123456789012345678.0,)], "x double")
    assert df.select(fixed_text("x", 2)).first()[0] == "123456789012345664.00"


def test_duplicate_source_keys_give_one_row(spark):
    target = spark.createDataFrame([("a", 0)], "k string, v int")
    source = spark.createDataFrame([("a", 5), ("a", 3), ("b", 1), ("b", 2)], "k string, v int")
    merged = merge_by_key(target, source, ["k"], ["v"], order=["v"])
    assert sorted(map(tuple, merged.collect())) == [("a", 5), ("b", 2)]
    inserted = insert_if_absent(target, source, ["k"], order=["v"])
    assert sorted(map(tuple, inserted.collect())) == [("a", 0), ("b", 2)]


def test_far_future_dates_are_read(spark, home):
    table = store.weather_table(f"{home}/weather")
    os.makedirs(f"{home.removeprefix('file://')}/weather/event_date=9999-12-31")
    assert store._days(spark, table) == ["9999-12-31"]
    assert store._days(spark, table, until=datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(days=1)) == []


def test_a_stored_alert_log_needs_its_checkpoint(spark, home):
    log = store.alert_table(f"{home}/alerts")
    os.makedirs(f"{home.removeprefix('file://')}/alerts/event_date=2024-01-01")
    rows = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="alerts"):
        jobs._start(rows, lambda *_: None, store.congestion_table(f"{home}/new"), f"{home}/cp", "append", None, [log.path])


def test_an_alert_topic_needs_servers():
    with pytest.raises(SystemExit):
        cli.main(["--tables", "t", "--feeds", "f", "stream", "traffic", "--alert-topic", "a"])
