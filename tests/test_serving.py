from pyspark.sql import functions as F

from helpers import rows, with_times
from roadpulse.operators import serving, vehicles
from roadpulse.operators.latest import latest_by
from roadpulse.sources import reference

METRIC = "corridor_id string, event_time string, congestion_index double, speed_kmh double, is_anomaly boolean"


def _metrics(spark, data):
    df = spark.createDataFrame(data, METRIC)
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def _pings(spark, data):
    df = spark.createDataFrame(
        data,
        "vehicle_id string, corridor_id string, latitude double, longitude double, speed_kmh double,"
        " event_time string, n long",
    )
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def test_latest_by_is_total_and_null_last(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 1), ("a", 2, 2), ("a", None, 9), ("b", None, 1)], "k string, t int, n int"
    )
    assert rows(latest_by(df, ["k"], ["t", "n"]), "*") == [("a", 2, 2), ("b", None, 1)]


def test_range_bounds_and_known_corridors(spark):
    corridors = reference.monitored_corridors(spark)
    metrics = _metrics(
        spark,
        [
            ("ring_road", "2024-01-01 10:00", 0.1, 1.0, False),
            ("ring_road", "2024-01-01 12:00", 0.2, None, None),
            ("nowhere", "2024-01-01 12:00", 0.3, 1.0, False),
        ],
    )
    since = "2024-01-01 10:00"
    assert serving.scan_metrics(metrics, corridors, since).count() == 2
    assert serving.scan_metrics(metrics, corridors, since, inclusive=False).count() == 1
    trend = serving.trend_series(metrics, corridors, "2024-01-01 12:00")
    assert rows(trend.drop("event_time"), "*") == [("ring_road", 0.2, 0.0, False)]
    keys = metrics.where("congestion_index > 0.15").select("corridor_id", "event_time")
    assert serving.lookup_metric(metrics, keys).count() == 2


def test_trend_is_ordered(spark):
    data = [("ring_road", f"2024-01-01 11:{m:02d}", m / 10, 1.0, False) for m in (50, 10, 30, 20)]
    got = serving.trend_series(_metrics(spark, data), reference.monitored_corridors(spark), "2024-01-01 12:00")
    assert [r.congestion_index for r in got.collect()] == [1.0, 2.0, 3.0, 5.0]


def test_status_bands_and_missing_corridors(spark):
    corridors = reference.monitored_corridors(spark)
    latest = serving.latest_per_corridor(
        _metrics(
            spark,
            [
                ("ring_road", "2024-01-01 10:00", 0.9, 9.0, True),
                ("ring_road", "2024-01-01 11:00", 0.7, 20.0, False),
                ("july26", "2024-01-01 11:00", 0.71, 12.0, True),
                ("salah_salem", "2024-01-01 11:00", 0.4, 30.0, False),
                ("october_bridge", "2024-01-01 11:00", 0.2, None, None),
                ("corniche_cairo", "2024-01-01 11:00", 0.21, 30.0, False),
                ("nowhere", "2024-01-01 11:00", 0.9, 1.0, True),
            ],
        ),
        corridors,
    )
    status = serving.corridor_status(corridors, latest)
    assert rows(status, "corridor_id", "congestion_index", "speed_kmh", "is_anomaly", "band", "color") == [
        ("alex_corniche", 0.0, 0.0, False, "Free Flow", "#00D4AA"),
        ("corniche_cairo", 0.21, 30.0, False, "Light", "#FFD700"),
        ("july26", 0.71, 12.0, True, "Severe", "#FF4444"),
        ("october_bridge", 0.2, 0.0, False, "Free Flow", "#00D4AA"),
        ("ring_road", 0.7, 20.0, False, "Moderate", "#FFA500"),
        ("salah_salem", 0.4, 30.0, False, "Light", "#FFD700"),
    ]
    kpi = serving.kpi_summary(corridors, latest).first()
    assert tuple(kpi)[:3] == (6, 5, 1)
    assert abs(kpi.avg_congestion - 0.444) < 1e-9 and abs(kpi.avg_speed - 18.4) < 1e-9


def test_kpis_of_nothing_are_zero(spark):
    corridors = reference.monitored_corridors(spark)
    latest = serving.latest_per_corridor(_metrics(spark, []), corridors)
    assert tuple(serving.kpi_summary(corridors, latest).first()) == (6, 0, 0, 0.0, 0.0)


PINGS = [
    ("v1", "ring_road", 1.0, 2.0, 10.0, "2024-01-01 10:00:00", 1),
    ("v1", "ring_road", 1.1, 2.1, 30.0, "2024-01-01 10:00:30", 2),
    ("v1", "ring_road", 1.2, 2.2, 14.9, "2024-01-01 10:00:30", 3),
    ("v2", "ring_road", 1.0, None, 50.0, "2024-01-01 09:00:00", 4),
    ("v3", "july26", 1.0, 2.0, None, "2024-01-01 10:00:00", 5),
    ("v4", "july26", 1.0, 2.0, 15.0, "2024-01-01 10:00:00", 6),
    ("v5", "july26", 1.0, 2.0, 30.0, "2024-01-01 10:00:00", 7),
]


def test_snapshot_lives_sixty_seconds(spark):
    pings = _pings(spark, PINGS)

    def tracked(as_of):
        snapshot = vehicles.vehicle_snapshot(pings, as_of, tie_breaks=("n",))
        return vehicles.vehicles_tracked(snapshot).first()[0]

    assert tracked("2024-01-01 10:01:30") == 5  # the feed's newest ping is exactly 60 s old
    assert tracked("2024-01-01 10:01:31") == 0
    assert vehicles.vehicle_snapshot(pings.limit(0), "2024-01-01").count() == 0


def test_snapshot_reads_the_feed_once(spark, home):
    _pings(spark, PINGS).write.parquet(home)
    snapshot = vehicles.vehicle_snapshot(spark.read.parquet(home), "2024-01-01 10:00:40", tie_breaks=("n",))
    assert rows(snapshot, "vehicle_id", "n") == [("v1", 3), ("v2", 4), ("v3", 5), ("v4", 6), ("v5", 7)]
    snapshot.collect()
    # the second use of the shuffle, and with it of the scan, is the first one's result
    assert "ReusedExchange" in snapshot._jdf.queryExecution().executedPlan().toString()


def test_markers_and_distribution(spark):
    snapshot = vehicles.vehicle_snapshot(_pings(spark, PINGS), "2024-01-01 10:00:40", tie_breaks=("n",))
    assert rows(vehicles.vehicle_markers(snapshot), "vehicle_id", "speed_kmh", "color") == [
        ("v1", 14.9, "#FF4444"),
        ("v3", 0.0, "#FF4444"),
        ("v4", 15.0, "#FFD700"),
        ("v5", 30.0, "#00D4AA"),
    ]
    spread = vehicles.vehicle_distribution(reference.monitored_corridors(spark), snapshot)
    assert rows(spread.where("vehicles > 0"), "corridor_id", "vehicles", "avg_speed_kmh") == [
        ("july26", 3, 15.0),
        ("ring_road", 2, 32.45),
    ]
    assert spread.count() == 6 and spread.where("vehicles = 0 and avg_speed_kmh = 0").count() == 4


def test_newest_row_of_a_corridor_reads_as_text(spark):
    corridors = reference.monitored_corridors(spark)
    metrics = _metrics(spark, [("ring_road", "2024-01-01 10:10", None, None, None)])
    got = with_times(serving.latest_per_corridor(metrics, corridors), "event_time")
    assert rows(got, "*") == [("ring_road", "2024-01-01 10:10:00", 0.0, 0.0, False)]
