import math

from pyspark.sql import functions as F

from helpers import rows
from roadpulse import settings
from roadpulse.operators import geometry, merge, quality
from roadpulse.operators.baselines import BASELINE_KEYS, BASELINE_VALUES
from roadpulse.sources import reference


def test_merge_updates_only_the_given_columns(spark):
    target = spark.createDataFrame(
        [("a", "old", 1.0, "x"), ("b", "keep", 2.0, None)],
        "corridor_id string, name string, distance_km double, name_ar string",
    )
    source = spark.createDataFrame(
        [("a", "new", 9.0), ("c", None, 3.0)], "corridor_id string, name string, distance_km double"
    )
    got = merge.merge_by_key(target, source, ["corridor_id"], ["name"])
    assert got.columns == target.columns
    assert rows(got, "*") == [("a", "new", 1.0, "x"), ("b", "keep", 2.0, None), ("c", None, 3.0, None)]


def test_merge_can_write_null_over_a_value(spark):
    target = spark.createDataFrame([("a", "old")], "k string, v string")
    source = spark.createDataFrame([("a", None)], "k string, v string")
    assert rows(merge.merge_by_key(target, source, ["k"], ["v"]), "*") == [("a", None)]


def test_stale_baselines_survive(spark):
    schema = "corridor_id string, day_of_week int, hour_of_day int, avg_travel_time_sec double, sample_count long, updated_at string, std_travel_time_sec double"
    old = spark.createDataFrame([("a", 0, 1, 60.0, 5, "old", 0.5), ("a", 0, 2, 61.0, 6, "old", None)], schema)
    new = spark.createDataFrame([("a", 0, 1, 90.0, 7, "new", None), ("a", 0, 3, 62.0, 8, "new", None)], schema).drop("std_travel_time_sec")
    got = merge.merge_by_key(old, new, BASELINE_KEYS, BASELINE_VALUES)
    assert rows(got, "*") == [
        ("a", 0, 1, 90.0, 7, "new", 0.5),
        ("a", 0, 2, 61.0, 6, "old", None),
        ("a", 0, 3, 62.0, 8, "new", None),
    ]


def test_insert_if_absent(spark):
    target = spark.createDataFrame([("a", "A", 1)], "k string, v string, extra int")
    source = spark.createDataFrame([("a", "other"), ("b", "B")], "k string, v string")
    assert rows(merge.insert_if_absent(target, source, ["k"]), "*") == [("a", "A", 1), ("b", "B", None)]


def test_retention_counts_from_the_write(spark):
    df = spark.createDataFrame(
        [("in", "2024-01-16 00:00:01"), ("edge", "2024-01-16 00:00:00"), ("out", "2024-01-10 00:00:00")],
        "k string, w string",
    ).select("k", F.col("w").cast("timestamp").alias("ingested_at"))
    assert rows(merge.expire(df, "2024-02-15"), "k") == [("in",)]


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("b",)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert rows(merge.orphan_rows(child, parent, ["k"]), "k") == [("b",)]


def _envelopes(spark, data):
    df = spark.createDataFrame(data, "topic string, partition int, offset long, ts string")
    return df.withColumn("timestamp", F.col("ts").cast("timestamp"))


def test_feed_states(spark):
    seen = _envelopes(
        spark,
        [
            ("healthy", 0, 1, "2024-01-01 11:45:00"),  # exactly 15 minutes old
            ("healthy", 1, 1, "2024-01-01 09:00:00"),
            ("stale", 0, 1, "2024-01-01 11:59:00"),  # an older offset may carry a newer time
            ("stale", 0, 2, "2024-01-01 11:44:59"),
            ("negative", 0, 1, "1969-12-31 23:59:59"),
            ("future", 0, 1, "2024-01-01 13:00:00"),
            ("gone", 0, 1, "2024-01-01 11:59:00"),
        ],
    )
    names = ["healthy", "stale", "negative", "future", "silent", "gone", "absent"]
    topics = reference.topic_names(spark, names, [n for n in names if n not in ("gone", "absent")])
    got = quality.feed_freshness(seen, topics, "2024-01-01 12:00:00")
    assert rows(got, "topic", "status") == [
        ("absent", "missing"), ("future", "healthy"), ("gone", "missing"), ("healthy", "healthy"),
        ("negative", "empty"), ("silent", "empty"), ("stale", "stale"),
    ]


def test_table_states(spark):
    def table(*times):
        df = spark.createDataFrame([(t,) for t in times], "t string")
        return df.select(F.col("t").cast("timestamp").alias("event_time"))

    got = quality.table_freshness(
        {
            "edge": table("2024-01-01 11:45:00", "2024-01-01 10:00:00"),
            "over": table("2024-01-01 11:44:59"),
            "ahead": table("2024-01-01 12:05:00"),
            "none": table(),
        },
        "2024-01-01 12:00:00",
    )
    assert rows(got, "table_name", "status", "age_minutes")[:2] == [
        ("ahead", "healthy", -5.0), ("edge", "healthy", 15.0),
    ]
    assert rows(got.where("table_name in ('none', 'over')"), "table_name", "status") == [
        ("none", "empty"), ("over", "stale"),
    ]


def test_reconcile_round_trip(spark):
    schema = "corridor_id string, event_time string, travel_time_sec int, congestion_index double, is_anomaly boolean"
    want = spark.createDataFrame(
        [
            ("CAIRO-RING-RD-SECTION-07", "t1", 540, 0.78, False),
            ("near", "t1", 1, 0.5, None),
            ("far", "t1", 1, 0.5, True),
            ("flag", "t1", 1, 0.5, True),
            ("lost", "t1", 1, 0.5, True),
            ("null", "t1", None, None, None),
        ],
        schema,
    )
    got = spark.createDataFrame(
        [
            ("CAIRO-RING-RD-SECTION-07", "t1", 540, 0.78, False),
            ("near", "t1", 1, 0.5 + 1e-7, None),
            ("far", "t1", 1, 0.501, True),
            ("flag", "t1", 1, 0.5, False),
            ("extra", "t1", 1, 0.5, True),
            ("null", "t1", None, None, None),
        ],
        schema,
    )
    result = quality.reconcile(want, got, ["corridor_id", "event_time"])
    assert rows(result.where("matched"), "corridor_id") == [("CAIRO-RING-RD-SECTION-07",), ("near",), ("null",)]
    failed = result.where("not matched")
    assert rows(failed, "corridor_id", "in_expected", "in_actual", "congestion_index_ok", "is_anomaly_ok") == [
        ("extra", False, True, False, False),
        ("far", True, True, False, True),
        ("flag", True, True, True, False),
        ("lost", True, False, False, False),
    ]


def _length(lat1, lon1, lat2, lon2):
    a1, b1, a2, b2 = map(math.radians, (lat1, lon1, lat2, lon2))
    h = math.sin((a2 - a1) / 2) ** 2 + math.cos(a1) * math.cos(a2) * math.sin((b2 - b1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def test_geometry(spark):
    corridors = reference.monitored_corridors(spark)
    got = {r.corridor_id: (r.length_km, r.heading) for r in geometry.corridor_geometry(corridors).collect()}
    headings = {"ring_road": 250.2, "corniche_cairo": 173.8, "october_bridge": 237.8,
                "salah_salem": 203.5, "july26": 282.3, "alex_corniche": 101.5}
    for c in settings.CORRIDORS:
        assert math.isclose(got[c[0]][0], _length(*c[3:7]), rel_tol=1e-9)
        assert got[c[0]][1] == headings[c[0]]


def test_headings_of_the_compass(spark):
    ends = {"n": (1.0, 0.0, 0.0), "e": (0.0, 1.0, 90.0), "s": (-1.0, 0.0, 180.0), "w": (0.0, -1.0, 270.0)}
    df = spark.createDataFrame(
        [(k, 0.0, 0.0, lat, lon) for k, (lat, lon, _) in ends.items()],
        "corridor_id string, start_lat double, start_lon double, end_lat double, end_lon double",
    )
    got = dict(rows(geometry.corridor_geometry(df), "corridor_id", "heading"))
    assert got == {k: v[2] for k, v in ends.items()}


def test_positions_match_plain_arithmetic(spark):
    pings = spark.createDataFrame(
        [(c[0], p / 37) for c in settings.CORRIDORS for p in range(37)] + [("nowhere", 0.5)],
        "corridor_id string, progress double",
    )
    got = geometry.ping_positions(pings, reference.monitored_corridors(spark)).collect()
    places = {c[0]: c[3:7] for c in settings.CORRIDORS}
    assert len(got) == 6 * 37
    for r in got:
        lat1, lon1, lat2, lon2 = places[r.corridor_id]
        assert r.latitude == round(lat1 + r.progress * (lat2 - lat1), 6)
        assert r.longitude == round(lon1 + r.progress * (lon2 - lon1), 6)
        assert r.progress_pct == round(r.progress * 100, 1)


def test_map_extent(spark):
    got = geometry.map_extent(reference.monitored_corridors(spark)).first()
    lats = [v for c in settings.CORRIDORS for v in (c[3], c[5])]
    lons = [v for c in settings.CORRIDORS for v in (c[4], c[6])]
    want = (sum(lats) / 12, sum(lons) / 12, min(lats) - 0.15, min(lons) - 0.15, max(lats) + 0.15, max(lons) + 0.15)
    assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(got, want))
