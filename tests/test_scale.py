"""Behaviour that only shows with hot keys and lookups too large to broadcast."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from roadpulse.operators.geometry import ping_positions
from roadpulse.operators.latest import latest_by
from roadpulse.operators.serving import scan_metrics
from roadpulse.operators.traffic import traffic_windows
from roadpulse.session import workspace


@contextmanager
def settings(spark, **conf):
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL_SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__shuffle__partitions": "16",
}


def _corridors(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("c"), "id").alias("corridor_id"),
        *[(F.col("id") * 0.001 + b).alias(c) for b, c in ((30, "start_lat"), (31, "start_lon"), (30.5, "end_lat"), (31.5, "end_lon"))],
    )


def _pings(spark, n):
    """A third of the pings lie on one corridor."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("c"), key.cast("string")).alias("corridor_id"),
        "id",
        ((F.col("id") % 100) / 100.0).alias("progress"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )


def test_hot_corridor_is_split_in_a_shuffled_join(spark):
    pings, corridors = _pings(spark, 60_000), _corridors(spark, 500)
    want = ping_positions(pings, corridors).agg(F.count("*"), F.sum(F.hash("id", "latitude"))).first()
    with settings(spark, **SMALL_SKEW):
        joined = ping_positions(pings, corridors)
        joined.collect()
        assert "skew=true" in plan(joined)
        assert joined.agg(F.count("*"), F.sum(F.hash("id", "latitude"))).first() == want

        metrics = pings.withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))
        known = scan_metrics(metrics, corridors, "2023-12-31")
        known.collect()
        assert "skew=true" in plan(known)
        assert known.count() == 60_000


def test_hot_keys_send_one_row_per_task(spark):
    """Of a third of all rows on one key, the shuffle only sees one row per task."""
    latest = latest_by(_pings(spark, 60_000), ["corridor_id"], ["id"])
    got = {r.corridor_id: r.id for r in latest.select("corridor_id", "id").collect()}
    assert got["c0"] == max(i for i in range(60_000) if i % 3 == 0 or i % 500 == 0)
    assert len(got) == 500
    text = plan(latest).split("== Physical Plan ==")[1]
    assert text.index("row_number(), 1, Final") < text.index("Exchange") < text.index("row_number(), 1, Partial")


def test_hot_window_is_combined_before_the_shuffle(spark):
    events = spark.range(0, 200_000, 1, 8).select(
        F.lit("ring_road").alias("corridor_id"),
        F.lit("2024-01-01 00:00:01").cast("timestamp").alias("event_time"),
        ((F.col("id") % 10) / 10.0).alias("congestion_index"),
        F.lit(30.0).alias("speed_kmh"),
    )
    windows = traffic_windows(events)
    assert rows(windows, "congestion_index", "speed_kmh") == [(0.45, 30.0)]
    text = plan(windows).split("== Physical Plan ==")[1]
    assert "partial_" in text and "SortAggregate" not in text


class _Session:
    """What ``workspace`` asks a session for."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder or default)})


def test_work_folders_lie_where_the_session_says():
    assert workspace(_Session("yarn", "/shared/"), "x").startswith("/shared/roadpulse/x-")
    assert workspace(_Session("local[2]", None), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(_Session("yarn", None), "x")
