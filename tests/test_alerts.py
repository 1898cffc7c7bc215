import json

from pyspark.sql import functions as F

from helpers import rows, with_times
from roadpulse import schemas
from roadpulse.operators import alerts as al
from roadpulse.sources import reference

NOW = "2025-11-14 07:21:00"


def _metrics(spark, data):
    df = spark.createDataFrame(
        data, "corridor_id string, event_time string, congestion_index double, speed_kmh double, is_anomaly boolean"
    )
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def test_alert_of_an_anomalous_row(spark):
    got = al.build_alerts(
        _metrics(
            spark,
            [
                ("corniche_cairo", "2025-11-14 07:20:00", 0.93, 11.4, True),
                ("july26", "2025-11-14 07:20:00", 0.1, 50.0, False),
                ("july26", "2025-11-14 07:30:00", 0.1, 50.0, None),
            ],
        ),
        NOW,
    )
    assert got.columns == schemas.CONGESTION_ALERTS.names
    assert rows(with_times(got, "event_time", "created_at"), "*") == [
        (
            "corniche_cairo", "congestion_spike", "high", 0.93, 11.4,
            "High congestion on corniche_cairo: index 0.93, speed 11.4 km/h",
            "2025-11-14 07:20:00", "2025-11-14 07:21:00",
        )
    ]
    key, value = al.alert_messages(got).first()
    assert key == "corniche_cairo"
    assert json.loads(value) == {
        "corridor_id": "corniche_cairo", "alert_type": "congestion_spike", "severity": "high",
        "congestion_index": 0.93, "speed_kmh": 11.4,
        "message": "High congestion on corniche_cairo: index 0.93, speed 11.4 km/h",
        "event_time": "2025-11-14T07:20:00Z", "created_at": "2025-11-14T07:21:00Z",
    }


def test_missing_speed_does_not_fail_an_alert(spark):
    got = al.build_alerts(_metrics(spark, [("a", "2025-11-14 07:20:00", 0.9, None, True)]), NOW)
    assert got.first().message == "High congestion on a: index 0.90, speed n/a km/h"


def _alerts(spark, data):
    df = spark.createDataFrame(
        data, "corridor_id string, severity string, congestion_index double, speed_kmh double, event_time string, message string"
    )
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def test_cards_levels_colors_and_defaults(spark):
    cards = al.format_alerts(
        _alerts(
            spark,
            [
                ("ring_road", "high", 0.85, 12.25, "2025-11-14 07:20:00", "m"),
                ("july26", "critical", 0.851, 1.0, "2025-11-14 07:20:00", ""),
                ("elsewhere", "odd", 0.7, 1.0, None, None),
                (None, None, None, None, None, None),
            ],
        ),
        reference.monitored_corridors(spark),
    )
    assert rows(cards, "corridor_id", "band", "band_color") == [
        ("elsewhere", "Moderate", "#FFA500"), ("july26", "Severe", "#FF4444"),
        ("ring_road", "Severe", "#FF4444"), ("unknown", "Free Flow", "#00D4AA"),
    ]
    messages = {r.key: json.loads(r.value) for r in al.card_messages(cards).collect()}
    assert messages["ring_road"] == {
        "title": "🟠 Congestion Alert — Ring Road",
        "color": 0xFF4444,
        "fields": [
            {"name": "🛣️ Corridor", "value": "**Ring Road**\n`ring_road`", "inline": True},
            {"name": "📊 Congestion Index", "value": "**0.85**", "inline": True},
            {"name": "🏎️ Speed", "value": "**12.2** km/h", "inline": True},
            {"name": "⏰ Event Time", "value": "`2025-11-14T07:20:00Z`", "inline": False},
        ],
        "footer": {"text": "Congestion Intelligence"},
        "description": "m",
    }
    assert "description" not in messages["july26"]
    cards = cards.drop("band", "band_color")
    assert {r.corridor_id: tuple(r)[1:] for r in cards.collect()} == {
        "ring_road": (
            "🟠 Congestion Alert — Ring Road", 0xFF4444, "**Ring Road**\n`ring_road`", "**0.85**",
            "**12.2** km/h", "`2025-11-14T07:20:00Z`", "m",
        ),
        "july26": (
            "🔴 Congestion Alert — 26th of July Corridor", 0xFF0000, "**26th of July Corridor**\n`july26`",
            "**0.85**", "**1.0** km/h", "`2025-11-14T07:20:00Z`", None,
        ),
        "elsewhere": (
            "🟡 Congestion Alert — elsewhere", 0xFF4444, "**elsewhere**\n`elsewhere`", "**0.70**",
            "**1.0** km/h", "`N/A`", None,
        ),
        "unknown": (
            "🟡 Congestion Alert — unknown", 0xFF4444, "**unknown**\n`unknown`", "**0.00**",
            "**0.0** km/h", "`N/A`", None,
        ),
    }


def test_recent_and_latest(spark):
    base = _metrics(spark, [(f"c{i}", f"2025-11-14 {i % 10:02d}:00:00", 0.9, 1.0, True) for i in range(30)])
    first, second = al.build_alerts(base, "2025-11-14 08:20"), al.build_alerts(base, "2025-11-14 09:20")
    log = first.unionByName(second)
    newest = al.recent_alerts(log).collect()
    assert len(newest) == 20 and len(al.recent_alerts(log, 7).collect()) == 7
    assert {r.created_at for r in newest} == {second.first().created_at}
    collapsed = al.latest_alerts(log)
    assert collapsed.count() == 30 and collapsed.select("created_at").distinct().count() == 1
