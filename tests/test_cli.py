"""The command line end to end over landed files."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from roadpulse import cli, schemas, settings
from roadpulse.operators.geometry import ping_positions
from roadpulse.plans import daily, report
from roadpulse.sources import reference
from roadpulse.streaming import store
from roadpulse.streaming.replay import envelopes


def _land(spark, home):
    """One day of three feeds: a congested corridor, a free one, and their vehicles."""
    times = spark.range(0, 1440, 2).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-30").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("event_time"),
        F.when(F.col("id") % 4 == 0, "ring_road").otherwise("july26").alias("corridor_id"),
    )
    hot = F.col("corridor_id") == "ring_road"
    traffic = times.withColumns({
        "congestion_index": F.when(hot, 0.9).otherwise(0.1), "speed_kmh": F.when(hot, 12.0).otherwise(50.0),
    })
    pings = times.withColumns({
        "vehicle_id": F.concat("corridor_id", F.lit("_v1")), "speed_kmh": F.when(hot, 12.0).otherwise(50.0),
        "progress": F.lit(0.5),
    })
    weather = times.select(
        "event_id", F.lit("Cairo").alias("location"),
        F.date_format("event_time", settings.WEATHER_TIME_FORMAT).alias("event_time"),
        F.lit(20.0).alias("temperature_c"), F.lit(3).alias("weather_code"),
    )
    placed = ping_positions(pings, reference.monitored_corridors(spark))
    for feed, kind in ((traffic.withColumn("length_m", F.lit(1)), "traffic"), (placed, "vehicle"), (weather, "weather")):
        envelopes(feed, kind).write.json(f"{home}/feeds/{kind}")


@pytest.fixture
def no_stop(monkeypatch, spark):
    monkeypatch.setattr(cli, "build_session", lambda *args: spark)


def test_whole_day(spark, home, no_stop, capsys):
    _land(spark, home)
    base = ["--tables", f"{home}/tables", "--feeds", f"{home}/feeds", "--as-of", "2024-01-30 23:59:00"]
    assert cli.main([*base, "check"]) == 1  # nothing there yet
    for kind in ("traffic", "vehicle", "weather"):
        extra = ["--alert-path", f"{home}/messages"] if kind == "traffic" else []
        assert cli.main([*base, "stream", kind, "--once", "--files-per-batch", "2", *extra]) == 0
    assert cli.main([*base, "daily"]) == 0
    assert cli.main([*base, "check"]) == 0
    assert cli.main([*base, "report"]) == 0
    out = capsys.readouterr().out
    assert "Congestion Alert — Ring Road" in out and "Overcast" in out and "Severe" in out

    tables = cli.Tables(f"{home}/tables")
    assert store.read_table(spark, tables.congestion).count() == 2 * 144
    assert store.read_log(spark, tables.alerts).count() == 144
    assert spark.read.json(f"{home}/messages").count() == 144
    corridors = daily.read_corridors(spark, tables.corridors)
    assert corridors.columns == schemas.CORRIDORS.names
    assert rows(corridors.where("corridor_id = 'ring_road'"), "name", "distance_km") == [("Ring Road", 18.5)]
    baselines = daily.read_baselines(spark, tables.baselines)
    assert baselines.columns == schemas.CONGESTION_BASELINES.names
    # Tuesday, and the window that ends at midnight on Wednesday
    assert baselines.where("day_of_week = 1").count() == 48 and baselines.count() == 50
    values = rows(baselines.where("hour_of_day = 10"), "corridor_id", "avg_travel_time_sec", "sample_count")
    assert values == [("july26", 66.0, 6), ("ring_road", 114.0, 6)]


def test_baselines_merge_and_empty_lists(spark, home):
    table = store.congestion_table(f"{home}/metrics")
    corridors = reference.monitored_corridors(spark)
    assert not daily.refresh_corridors(spark, corridors.limit(0), f"{home}/corridors")
    assert daily.read_corridors(spark, f"{home}/corridors").count() == 0
    assert daily.recalculate_baselines(spark, table, corridors, f"{home}/baselines", "2024-01-08") == 0

    def write(day, index, batch):
        row = spark.createDataFrame([("ring_road", day, index)], "corridor_id string, t string, congestion_index double")
        full = row.withColumns({
            "event_time": F.col("t").cast("timestamp"), "travel_time_sec": F.lit(0), "free_flow_sec": F.lit(0),
            "speed_kmh": F.lit(1.0), "is_anomaly": F.lit(False),
        })
        store.write_version(full, table, store.batch_version(batch), written_at=day)

    write("2024-01-01 10:00:00", 1.0, 0)
    assert daily.recalculate_baselines(spark, table, corridors, f"{home}/baselines", "2024-01-03") == 1
    write("2024-01-09 10:00:00", 2.0, 1)
    assert daily.recalculate_baselines(spark, table, corridors, f"{home}/baselines", "2024-01-10") == 1
    kept = daily.read_baselines(spark, f"{home}/baselines")
    assert rows(kept, "day_of_week", "avg_travel_time_sec") == [(0, 120.0), (1, 180.0)]
    folded, dropped = daily.tidy(spark, table, "2024-02-05")
    assert (folded, dropped) == (1, 1)
    assert store.read_table(spark, table).count() == 1


def test_feed_checks(spark):
    seen = spark.createDataFrame(
        [(settings.TOPICS["traffic"], 0, 1, "2024-01-01 11:50:00")], "topic string, partition int, offset long, t string"
    ).withColumn("timestamp", F.col("t").cast("timestamp"))
    existing = [settings.TOPICS["traffic"], settings.TOPICS["weather"]]
    checks = report.check_feeds(spark, seen, existing, "2024-01-01 12:00:00")
    assert rows(checks, "topic", "status") == [
        ("traffic_events", "healthy"), ("vehicle_position_events", "missing"), ("weather_events", "empty"),
    ]
    assert not report.log_states(checks, "topic")


def test_disk_state_store(spark, home):
    """The provider the command line sets keeps the same results."""
    from test_streaming import Traffic, _event, _land as land

    for key, value in cli.STREAM_CONF.items():
        spark.conf.set(key, value)
    try:
        job = Traffic(spark, home)
        land(spark, job.feed, [_event(m, 0.4) for m in range(15)])
        job.run()
        land(spark, job.feed, [_event(m, 0.8) for m in range(15, 30)], 100)
        job.run()
        assert [v[2] for v in job.values()] == [0.4, 0.6, 0.8]
    finally:
        for key in cli.STREAM_CONF:
            spark.conf.unset(key)


def test_check_of_landed_feeds(spark, home):
    args = cli.parser().parse_args(["--tables", home, "--feeds", f"{home}/feeds", "check", "--with-feeds"])
    seen, existing = cli._landed(spark, args)
    assert (seen.count(), existing) == (0, [])
    sent = [(0, 1, "2024-01-01 10:00:00"), (0, 2, "2024-01-01 11:50:00"), (1, 1, "2024-01-01 09:00:00")]
    landed = spark.createDataFrame(sent, "partition int, offset long, t string")
    landed.withColumn("timestamp", F.col("t").cast("timestamp")).write.json(f"{home}/feeds/weather")
    seen, existing = cli._landed(spark, args)
    checks = report.check_feeds(spark, seen, existing, "2024-01-01 12:00:00")
    assert rows(checks, "topic", "status") == [
        ("traffic_events", "missing"), ("vehicle_position_events", "missing"), ("weather_events", "healthy"),
    ]
