"""The same queries as plain SQL, to check the engine against another one.

Every statement starts from the given tables. Text shared by several statements (the feeds
derived from events, and the arithmetic of rounding and averaging) is kept in pieces.
"""

from __future__ import annotations

from roadpulse import settings
from roadpulse.plans.catalog import AS_OF, LATE_UNTIL, SLICE_BOUNDS


# --- arithmetic -------------------------------------------------------------------------


def _avg(x: str) -> str:
    return f"(sum(cast({x} AS DECIMAL(28, 9)))::DOUBLE / count({x}))"


def _round(x: str, digits: int) -> str:
    """Nearest by the exact binary value, ties to even; x is a column name."""
    scale = f"{10 ** digits}::DOUBLE"
    product = f"({x} * {scale})"
    high = f"({x} * 134217729::DOUBLE - ({x} * 134217729::DOUBLE - {x}))"
    error = f"(({high} * {scale} - {product}) + ({x} - {high}) * {scale})"
    near = f"round_even({product}, 0)"
    return (
        f"(({near} + CASE WHEN {product} - {near} = 0.5 AND {error} > 0 THEN 1 "
        f"WHEN {product} - {near} = -0.5 AND {error} < 0 THEN -1 ELSE 0 END) / {scale})"
    )


def _text(x: str, digits: int) -> str:
    return f"cast(cast({_round(x, digits)} AS DECIMAL(18,{digits})) AS VARCHAR)"


def _q(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _list(values, index: str) -> str:
    items = ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values)
    return f"list_extract([{items}], cast({index} + 1 AS BIGINT))"


def _values(rows, names: str) -> str:
    body = ", ".join(
        "(" + ", ".join(_q(v) if isinstance(v, str) else f"{v}" for v in row) + ")" for row in rows
    )
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


def _query(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes) + "\n" + body


# --- feeds ------------------------------------------------------------------------------

_C = settings.CORRIDORS
_AS_OF = f"TIMESTAMP '{AS_OF}'"

CORRIDORS = (
    "corridors",
    "SELECT corridor_id, name, city, start_lat::DOUBLE AS start_lat, start_lon::DOUBLE AS start_lon,"
    " end_lat::DOUBLE AS end_lat, end_lon::DOUBLE AS end_lon, distance_km::DOUBLE AS distance_km FROM ("
    + _values(
        _C, "corridor_id, name, city, start_lat, start_lon, end_lat, end_lon, distance_km"
    )
    + ")",
)

EV = (
    "ev",
    "SELECT event_id, ts AS event_time, user_id, cast(floor(value * 100 + 0.5) AS BIGINT) AS cents,"
    " cast(user_id % 6 AS INTEGER) AS ix FROM events",
)

TIMES = (
    "times",
    "SELECT *, cast(free_flow_sec * (cents + 8000) // 10000 AS INTEGER) AS travel_time_sec FROM ("
    " SELECT *, cast(length_m * 3 // 50 AS INTEGER) AS free_flow_sec FROM ("
    f" SELECT *, {_list([c[0] for c in _C], 'ix')} AS corridor_id,"
    f" {_list([c[1] for c in _C], 'ix')} AS corridor_name, {_list([c[2] for c in _C], 'ix')} AS city,"
    f" cast({_list([round(c[7] * 1000) for c in _C], 'ix')} AS INTEGER) AS length_m FROM ev))",
)

TRAFFIC = (
    "traffic",
    "SELECT event_id, corridor_id, corridor_name, city, travel_time_sec, free_flow_sec, length_m,"
    f" event_time, {_round('raw_index', 2)} AS congestion_index, {_round('raw_speed', 1)} AS speed_kmh,"
    f" {_round('raw_distance', 1)} AS distance_km, raw_index > 1.5 AS is_anomaly FROM ("
    " SELECT *, greatest(0::DOUBLE, (travel_time_sec - free_flow_sec)::DOUBLE / free_flow_sec) AS raw_index,"
    " (length_m::DOUBLE / 1000) / (travel_time_sec::DOUBLE / 3600) AS raw_speed,"
    " length_m::DOUBLE / 1000 AS raw_distance FROM times)",
)

TRAFFIC_FEED = [EV, TIMES, TRAFFIC]


def _windows(source: str = "traffic", where: str = "true") -> str:
    return (
        "SELECT corridor_id, event_time, 0 AS travel_time_sec, 0 AS free_flow_sec, congestion_index,"
        " speed_kmh, coalesce(congestion_index > 0.7 OR speed_kmh < 15, false) AS is_anomaly FROM ("
        " SELECT corridor_id, time_bucket(INTERVAL '10 minutes', event_time) + INTERVAL '10 minutes' AS event_time,"
        f" {_avg('congestion_index')} AS congestion_index, {_avg('speed_kmh')} AS speed_kmh"
        f" FROM {source} WHERE {where} GROUP BY 1, 2)"
    )


METRICS = [*TRAFFIC_FEED, ("metrics", _windows())]

PINGS = [
    EV,
    (
        "pings",
        f"SELECT event_id, {_list([c[0] for c in _C], 'ix')} || '_v' || ((user_id // 6) % 3 + 1) AS vehicle_id,"
        f" {_list([c[0] for c in _C], 'ix')} AS corridor_id, 5::DOUBLE + (cents % 4600) / 100::DOUBLE AS speed_kmh,"
        " (event_id % 1000) / 1000::DOUBLE AS progress, event_time FROM ev",
    ),
]


def _geometry(source: str) -> str:
    """Length and bearing of each corridor of a source."""
    a, b = "radians(start_lat)", "radians(end_lat)"
    turn = "radians(end_lon - start_lon)"
    half_lat = f"(({b} - {a}) / 2)"
    half_lon = "((radians(end_lon) - radians(start_lon)) / 2)"
    return (
        "SELECT *, 12742::DOUBLE * atan2(sqrt(chord), sqrt(1::DOUBLE - chord)) AS length_km,"
        " fmod(degrees(atan2(east, north)) + 360, 360) AS bearing FROM ("
        f" SELECT *, sin({half_lat}) * sin({half_lat}) + cos({a}) * cos({b}) * (sin({half_lon}) * sin({half_lon})) AS chord,"
        f" sin({turn}) * cos({b}) AS east,"
        f" cos({a}) * sin({b}) - sin({a}) * cos({b}) * cos({turn}) AS north FROM {source})"
    )


PLACES = [CORRIDORS, ("places", _geometry("corridors"))]


def _placed(source: str) -> str:
    return (
        f"SELECT event_id, vehicle_id, corridor_id, speed_kmh, progress, event_time, {_round('bearing', 1)} AS heading,"
        f" {_round('raw_lat', 6)} AS latitude, {_round('raw_lon', 6)} AS longitude, {_round('raw_pct', 1)} AS progress_pct FROM ("
        " SELECT p.*, c.bearing, c.start_lat + p.progress * (c.end_lat - c.start_lat) AS raw_lat,"
        " c.start_lon + p.progress * (c.end_lon - c.start_lon) AS raw_lon, p.progress * 100 AS raw_pct"
        f" FROM {source} p JOIN places c ON p.corridor_id = c.corridor_id)"
    )


VEHICLE_WINDOWS = (
    "vehicle_speed",
    "SELECT corridor_id, event_time, avg_speed_kmh, coalesce(avg_speed_kmh < 20, false) AS is_anomaly FROM ("
    " SELECT corridor_id, time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS event_time,"
    f" {_avg('speed_kmh')} AS avg_speed_kmh FROM pings GROUP BY 1, 2)",
)

SNAPSHOT = [
    *PINGS,
    (
        "snapshot",
        "SELECT * FROM pings QUALIFY row_number() OVER"
        " (PARTITION BY vehicle_id ORDER BY event_time DESC, event_id DESC) = 1",
    ),
]

WEATHER = [
    EV,
    (
        "weather",
        "SELECT event_id,"
        f" CASE WHEN event_id % 101 <> 0 THEN {_list(list(settings.WEATHER_CITIES), 'user_id % 2')} END AS location,"
        f" {_list([p[1] for p in settings.WEATHER_LOCATIONS], 'user_id % 2')}::DOUBLE AS latitude,"
        f" {_list([p[2] for p in settings.WEATHER_LOCATIONS], 'user_id % 2')}::DOUBLE AS longitude,"
        " CASE WHEN event_id % 97 = 0 THEN strftime(event_time, '%Y-%m-%d %H:%M')"
        " ELSE strftime(event_time, '%Y-%m-%dT%H:%M') END AS time_text,"
        " 15::DOUBLE + (cents % 2500) / 100::DOUBLE AS temperature_c, (event_id % 100)::DOUBLE AS humidity_pct,"
        " (event_id % 50) / 10::DOUBLE AS precipitation_mm, (user_id % 400) / 10::DOUBLE AS wind_speed_kmh,"
        f" cast({_list([c[0] for c in settings.WEATHER_CODES] + [99], 'event_id % 17')} AS INTEGER) AS weather_code FROM ev",
    ),
    (
        "clean",
        "SELECT * FROM (SELECT *, try_strptime(time_text, '%Y-%m-%dT%H:%M') AS event_time FROM weather)"
        " WHERE location IS NOT NULL AND event_time IS NOT NULL",
    ),
    (
        "weather_metrics",
        "SELECT location, event_time, temperature_c, humidity_pct, precipitation_mm, wind_speed_kmh, weather_code"
        " FROM clean QUALIFY row_number() OVER (PARTITION BY location, event_time ORDER BY event_id DESC) = 1",
    ),
]


def _listing(name: str, table: str, key: str, label: str, step: int = 1) -> tuple[str, str]:
    def spread(base: int, factor: int) -> str:
        return f"{base}::DOUBLE + (({key} * {factor}) % 10000) / 10000::DOUBLE"

    return (
        name,
        f"SELECT 'c' || ({key} * {step}) AS corridor_id,"
        f" CASE WHEN {key} % 5 <> 0 THEN {label} ELSE 'c' || ({key} * {step}) END AS name,"
        f" CASE WHEN {key} % 7 <> 0 THEN 'Alexandria' ELSE 'Cairo' END AS city,"
        f" {spread(30, 37)} AS start_lat, {spread(31, 53)} AS start_lon,"
        f" {spread(30, 71)} AS end_lat, {spread(31, 89)} AS end_lon FROM {table}",
    )


_LISTED = "corridor_id, name, city, start_lat, start_lon, end_lat, end_lon"
MERGE_SIDES = [
    _listing("source", "customer", "c_custkey", "c_name", 3),
    _listing("listed", "part", "p_partkey", "p_name", 2),
    (
        "target",
        "SELECT listed.*, p_size::DOUBLE AS distance_km FROM listed"
        " JOIN part ON listed.corridor_id = 'c' || (p_partkey * 2)",
    ),
]

LATEST = [
    *METRICS,
    (
        "latest",
        "SELECT corridor_id, event_time, congestion_index, speed_kmh, is_anomaly FROM metrics"
        " QUALIFY row_number() OVER (PARTITION BY corridor_id ORDER BY event_time DESC) = 1",
    ),
]


def _alerts(source: str, created: str = _AS_OF) -> str:
    return (
        "SELECT corridor_id, 'congestion_spike' AS alert_type, 'high' AS severity, congestion_index, speed_kmh,"
        f" 'High congestion on ' || corridor_id || ': index ' || {_text('congestion_index', 2)} || ', speed ' ||"
        f" {_text('speed_kmh', 1)} || ' km/h' AS message, event_time, {created} AS created_at"
        f" FROM {source} WHERE is_anomaly"
    )


ALERTS = [*METRICS, ("alerts", _alerts("metrics"))]


def _baselines(name: str, as_of: str) -> list[tuple[str, str]]:
    return [
        (
            f"{name}_metrics",
            _windows(
                where=f"event_time >= {as_of} - INTERVAL '7 days 10 minutes' AND event_time < {as_of}"
            ),
        ),
        (
            name,
            "SELECT corridor_id, cast(isodow(event_time) - 1 AS INTEGER) AS day_of_week,"
            " cast(hour(event_time) AS INTEGER) AS hour_of_day,"
            f" {_avg('((congestion_index + 1) * 60)')} AS avg_travel_time_sec, count(*) AS sample_count,"
            f" {as_of} AS updated_at FROM {name}_metrics"
            f" WHERE event_time >= {as_of} - INTERVAL '7 days'"
            " AND congestion_index IS NOT NULL AND speed_kmh IS NOT NULL GROUP BY 1, 2, 3",
        ),
    ]


BASELINES = [*TRAFFIC_FEED, *_baselines("fresh", _AS_OF)]


def _case(pairs, subject: str, default) -> str:
    arms = " ".join(f"WHEN {subject} {op} THEN {_q(v)}" for op, v in pairs)
    return f"CASE {arms} ELSE {_q(default)} END"


def _band(x: str, names) -> str:
    return _case(zip(("> 0.7", "> 0.4", "> 0.2"), names), x, names[3])


_BANDS = (settings.BAND_SEVERE, settings.BAND_MODERATE, settings.BAND_LIGHT, settings.BAND_FREE)
_COLORS = (settings.COLOR_RED, settings.COLOR_ORANGE, settings.COLOR_YELLOW, settings.COLOR_GREEN)

_STATUS = "CASE WHEN newest IS NULL THEN 'empty' WHEN age_minutes > 15 THEN 'stale' ELSE 'healthy' END"
_AGE = f"(epoch_us({_AS_OF}) - epoch_us(newest)) / 60000000::DOUBLE"


# Slice number of a traffic event, by the moments at which the stream was restarted.
_SLICE = " + ".join(f"cast(event_time >= TIMESTAMP '{b}' AS INTEGER)" for b in SLICE_BOUNDS[1:-1])

# Each restart runs one batch of data and one that only moves the watermark.
_BATCH = "cast(2 * slice AS BIGINT) AS batch_id"

# Running totals of each window at the end of every slice that touched it.
STREAM_STEPS = [
    *TRAFFIC_FEED,
    (
        "parts",
        f"SELECT corridor_id, time_bucket(INTERVAL '10 minutes', event_time) + INTERVAL '10 minutes' AS window_end,"
        f" {_SLICE} AS slice, sum(cast(floor(congestion_index * 1e9 + 0.5) AS BIGINT)) AS i,"
        " sum(cast(floor(speed_kmh * 1e9 + 0.5) AS BIGINT)) AS s, count(*) AS n"
        " FROM traffic GROUP BY 1, 2, 3",
    ),
    (
        "steps",
        "SELECT corridor_id, window_end AS event_time, slice,"
        " cast(sum(i) OVER w AS DOUBLE) / 1e9 / sum(n) OVER w AS congestion_index,"
        " cast(sum(s) OVER w AS DOUBLE) / 1e9 / sum(n) OVER w AS speed_kmh FROM parts"
        " WINDOW w AS (PARTITION BY corridor_id, window_end ORDER BY slice)",
    ),
    (
        "flagged",
        "SELECT *, congestion_index > 0.7 OR speed_kmh < 15 AS is_anomaly FROM steps",
    ),
]


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["traffic_metrics"] = _query(TRAFFIC_FEED, "SELECT * FROM traffic")
    sql["traffic_windows"] = _query(METRICS, "SELECT * FROM metrics")
    sql["vehicle_windows"] = _query([*PINGS, VEHICLE_WINDOWS], "SELECT * FROM vehicle_speed")
    sql["weather_clean"] = _query(WEATHER, "SELECT * FROM weather_metrics")

    def readable(column: str, alias: str | None = None) -> str:
        return f"CASE WHEN event_id % 97 <> 0 THEN {column} END AS {alias or column}"

    whole = "date_trunc('second', event_time)"
    payload = ["corridor_id", "corridor_name", "city", "free_flow_sec", "congestion_index",
               "speed_kmh", "distance_km", "is_anomaly"]
    sql["decode_traffic"] = _query(
        TRAFFIC_FEED,
        f"SELECT event_id, {', '.join(readable(c) for c in payload)}, {readable(whole, 'event_time')},"
        " CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 THEN travel_time_sec END AS travel_time_sec"
        " FROM traffic",
    )
    ping = ["vehicle_id", "corridor_id", "latitude", "longitude", "speed_kmh", "heading", "progress_pct"]
    sql["decode_vehicle"] = _query(
        [*PINGS, *PLACES, ("placed", _placed("pings"))],
        f"SELECT event_id, {', '.join(readable(c) for c in ping)}, {readable(whole, 'event_time')} FROM placed",
    )
    report = ["location", "latitude", "longitude", "temperature_c", "humidity_pct", "precipitation_mm",
              "wind_speed_kmh", "weather_code"]
    sql["decode_weather"] = _query(
        WEATHER,
        f"SELECT event_id, {', '.join(readable(c) for c in report)},"
        " try_strptime(time_text, '%Y-%m-%dT%H:%M') AS event_time FROM weather",
    )
    sql["encode_decode_roundtrip"] = _query(
        TRAFFIC_FEED,
        "SELECT event_id, corridor_id AS key, corridor_id, corridor_name, city, travel_time_sec, free_flow_sec,"
        f" congestion_index, speed_kmh, distance_km, is_anomaly, {whole} AS event_time FROM traffic",
    )
    sql["route_document_flatten"] = _query(
        [EV, TIMES],
        "SELECT event_id, corridor_id, travel_time_sec, free_flow_sec, length_m FROM times"
        " WHERE event_id % 97 <> 0 AND event_id % 101 <> 0",
    )
    current = ["temperature_c", "humidity_pct", "precipitation_mm", "wind_speed_kmh", "weather_code"]
    sql["weather_document_flatten"] = _query(
        WEATHER,
        f"SELECT event_id, coalesce(location, 'Elsewhere') AS location, {readable('time_text', 'event_time')},"
        f" {', '.join(readable(c) for c in current)}, CASE WHEN location IS NOT NULL THEN latitude END AS latitude,"
        " CASE WHEN location IS NOT NULL THEN longitude END AS longitude FROM weather",
    )

    sql["corridor_reference"] = _query(
        [_listing("listed", "supplier", "s_suppkey", "s_name")], "SELECT * FROM listed"
    )
    sql["corridor_merge"] = _query(
        MERGE_SIDES,
        "SELECT coalesce(s.corridor_id, t.corridor_id) AS corridor_id, "
        + ", ".join(
            f"CASE WHEN s.corridor_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
            for c in _LISTED.split(", ")[1:]
        )
        + ", t.distance_km FROM target t FULL OUTER JOIN source s ON t.corridor_id = s.corridor_id",
    )
    sql["corridor_seed_insert"] = _query(
        MERGE_SIDES,
        f"SELECT {_LISTED}, distance_km FROM target UNION ALL SELECT {_LISTED}, NULL::DOUBLE FROM source"
        " WHERE corridor_id NOT IN (SELECT corridor_id FROM target)",
    )
    sql["corridor_geometry"] = _query(
        [_listing("listed", "part", "p_partkey", "p_name"), ("measured", _geometry("listed"))],
        f"SELECT corridor_id, {_round('length_km', 6)} AS length_km, {_round('bearing', 1)} AS heading FROM measured",
    )
    sql["map_extent"] = _query(
        [
            _listing("listed", "customer", "c_custkey", "c_name"),
            (
                "points",
                "SELECT start_lat AS lat, start_lon AS lon FROM listed"
                " UNION ALL SELECT end_lat, end_lon FROM listed",
            ),
        ],
        f"SELECT {_avg('lat')} AS center_lat, {_avg('lon')} AS center_lon, min(lat) - 0.15::DOUBLE AS south,"
        " min(lon) - 0.15::DOUBLE AS west, max(lat) + 0.15::DOUBLE AS north, max(lon) + 0.15::DOUBLE AS east FROM points",
    )
    sql["ping_positions"] = _query([*PINGS, *PLACES], _placed("pings"))

    sql["metrics_since"] = _query(
        METRICS,
        f"SELECT * FROM metrics WHERE event_time >= {_AS_OF} - INTERVAL '7 days' AND corridor_id <> 'alex_corniche'",
    )
    sql["metric_point_lookup"] = _query(
        [*METRICS, PINGS[1], VEHICLE_WINDOWS],
        "SELECT * FROM metrics WHERE (corridor_id, event_time) IN"
        " (SELECT (corridor_id, event_time) FROM vehicle_speed WHERE is_anomaly)",
    )
    sql["stored_point_lookup"] = sql["metric_point_lookup"]
    sql["latest_per_corridor"] = _query(LATEST, "SELECT * FROM latest")
    index = "coalesce(l.congestion_index, 0)"
    sql["corridor_status"] = _query(
        [CORRIDORS, *LATEST],
        f"SELECT c.corridor_id, c.name, c.city, l.event_time, {index} AS congestion_index,"
        " coalesce(l.speed_kmh, 0) AS speed_kmh, coalesce(l.is_anomaly, false) AS is_anomaly,"
        f" {_band(index, _BANDS)} AS band, {_band(index, _COLORS)} AS color,"
        f" CASE WHEN coalesce(l.is_anomaly, false) THEN '{settings.ICON_RED}' ELSE '{settings.ICON_GREEN}' END AS status_icon"
        " FROM corridors c LEFT JOIN latest l ON c.corridor_id = l.corridor_id",
    )
    sql["kpi_summary"] = _query(
        [CORRIDORS, *LATEST],
        "SELECT count(*) AS corridors_total, count(l.corridor_id) AS corridors_monitored,"
        " count(*) FILTER (WHERE l.is_anomaly) AS active_anomalies,"
        f" coalesce({_avg('l.congestion_index')}, 0) AS avg_congestion, coalesce({_avg('l.speed_kmh')}, 0) AS avg_speed"
        " FROM corridors c LEFT JOIN latest l ON c.corridor_id = l.corridor_id",
    )
    sql["trend_series"] = _query(
        METRICS,
        "SELECT corridor_id, event_time, congestion_index, speed_kmh, is_anomaly FROM metrics"
        f" WHERE event_time > {_AS_OF} - INTERVAL '2 hours' ORDER BY corridor_id, event_time",
    )
    name, icon = settings.UNKNOWN_WEATHER
    sql["weather_now"] = _query(
        [*WEATHER, ("codes", _values(settings.WEATHER_CODES, "weather_code, description, icon"))],
        f"SELECT w.*, coalesce(c.description, {_q(name)}) AS description, coalesce(c.icon, {_q(icon)}) AS icon FROM ("
        " SELECT * FROM weather_metrics QUALIFY row_number() OVER (PARTITION BY location ORDER BY event_time DESC) = 1"
        ") w LEFT JOIN codes c ON w.weather_code = c.weather_code",
    )
    sql["vehicle_snapshot"] = _query([*SNAPSHOT, *PLACES], _placed("snapshot"))
    marker = _case(
        (("< 15", settings.COLOR_RED), ("< 30", settings.COLOR_YELLOW)),
        "speed_kmh",
        settings.COLOR_GREEN,
    )
    sql["vehicle_markers"] = _query(
        [*SNAPSHOT, *PLACES, ("placed", _placed("snapshot"))],
        f"SELECT vehicle_id, corridor_id, latitude, longitude, speed_kmh, {marker} AS color FROM placed",
    )
    sql["vehicle_distribution"] = _query(
        [CORRIDORS, *SNAPSHOT],
        "SELECT c.corridor_id, c.name, count(s.vehicle_id) AS vehicles,"
        f" coalesce({_avg('s.speed_kmh')}, 0) AS avg_speed_kmh"
        " FROM corridors c LEFT JOIN snapshot s ON c.corridor_id = s.corridor_id GROUP BY 1, 2",
    )
    sql["vehicles_tracked"] = _query(SNAPSHOT, "SELECT count(*) AS vehicles_tracked FROM snapshot")

    sql["congestion_alerts"] = _query(
        ALERTS, "SELECT *, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS event_time_text FROM alerts"
    )
    level = _case(
        (("> 0.85", settings.ICON_RED), ("> 0.7", settings.ICON_ORANGE)),
        "a.congestion_index",
        settings.ICON_YELLOW,
    )
    cards = (
        f"SELECT a.corridor_id, {level} || ' Congestion Alert — ' || coalesce(c.name, a.corridor_id) AS title,"
        f" cast({dict(settings.SEVERITY_COLORS)['high']} AS INTEGER) AS color,"
        f" {_band('a.congestion_index', _BANDS)} AS band, {_band('a.congestion_index', _COLORS)} AS band_color,"
        " '**' || coalesce(c.name, a.corridor_id) || '**' || chr(10) || '`' || a.corridor_id || '`' AS corridor_field,"
        f" '**' || {_text('a.congestion_index', 2)} || '**' AS index_field,"
        f" '**' || {_text('a.speed_kmh', 1)} || '** km/h' AS speed_field,"
        " '`' || strftime(a.event_time, '%Y-%m-%dT%H:%M:%SZ') || '`' AS time_field, a.message AS description"
        " FROM alerts a LEFT JOIN corridors c ON a.corridor_id = c.corridor_id"
    )
    sql["alert_cards"] = _query([CORRIDORS, *ALERTS], f"{cards} AND c.corridor_id <> 'july26'")
    fields = ", ".join(
        f"{{'name': '{label}', 'value': {column}, 'inline': {str(line).lower()}}}"
        for column, label, line in settings.CARD_FIELDS
    )
    sql["alert_card_messages"] = _query(
        [CORRIDORS, *ALERTS, ("cards", cards)],
        "SELECT corridor_id AS key, cast(to_json({'title': title, 'color': color, 'fields': "
        f"[{fields}], 'footer': {{'text': '{settings.CARD_FOOTER}'}}, 'description': description}}) AS VARCHAR)"
        " AS value FROM cards",
    )
    sql["latest_alerts"] = _query(
        ALERTS,
        f"SELECT * REPLACE (CASE WHEN hour(event_time) < 12 THEN {_AS_OF}"
        f" ELSE {_AS_OF} - INTERVAL '1 day' END AS created_at) FROM alerts",
    )
    sql["recent_alerts"] = _query(
        ALERTS,
        "SELECT * FROM alerts ORDER BY created_at DESC, event_time DESC, corridor_id LIMIT 20",
    )

    keys = "corridor_id, day_of_week, hour_of_day"
    sql["baselines"] = _query(BASELINES, "SELECT * FROM fresh")
    sql["baseline_parts"] = sql["baselines"]
    sql["baseline_merge"] = _query(
        [*BASELINES, *_baselines("stale", f"({_AS_OF} - INTERVAL '7 days')")],
        f"SELECT {keys}, avg_travel_time_sec, sample_count, updated_at FROM fresh UNION ALL"
        f" SELECT {keys}, avg_travel_time_sec, sample_count, updated_at FROM stale"
        f" WHERE ({keys}) NOT IN (SELECT ({keys}) FROM fresh)",
    )
    sql["baseline_orphans"] = _query(
        BASELINES, "SELECT * FROM fresh WHERE corridor_id = 'salah_salem'"
    )
    sql["retention_filter"] = _query(
        TRAFFIC_FEED,
        "SELECT *, event_time AS ingested_at FROM traffic"
        " WHERE event_time > TIMESTAMP '2024-02-15' - INTERVAL '30 days'",
    )

    t = settings.TOPICS
    sql["feed_freshness"] = _query(
        [
            ("traffic_rows", "SELECT user_id % 3 AS partition, event_id, ts FROM events"),
            ("weather_rows", "SELECT * FROM traffic_rows WHERE ts < TIMESTAMP '2024-01-30'"),
            (
                "last_times",
                f"SELECT {_q(t['traffic'])} AS topic, max(newest) AS newest FROM (SELECT partition, max_by(ts, event_id) AS newest"
                f" FROM traffic_rows GROUP BY 1) UNION ALL SELECT {_q(t['weather'])}, max(newest) FROM (SELECT partition,"
                " max_by(ts, event_id) AS newest FROM weather_rows GROUP BY 1)",
            ),
            ("aged", f"SELECT *, {_AGE} AS age_minutes FROM last_times"),
        ],
        f"SELECT topic, newest, age_minutes, {_STATUS} AS status FROM aged UNION ALL"
        f" SELECT {_q(t['vehicle'])}, NULL, NULL, 'missing'",
    )
    sql["table_freshness"] = _query(
        [
            *METRICS,
            *WEATHER[1:],
            (
                "newest_rows",
                "SELECT 'congestion_metrics' AS table_name, max(event_time) AS newest FROM metrics"
                " UNION ALL SELECT 'weather_metrics', max(event_time) FROM clean",
            ),
            ("aged", f"SELECT *, {_AGE} AS age_minutes FROM newest_rows"),
        ],
        f"SELECT *, {_STATUS} AS status FROM aged",
    )
    lost = "(corridor_id = 'salah_salem' AND event_time >= TIMESTAMP '2024-01-20')"
    there = f"NOT {lost}"
    sql["metric_reconcile"] = _query(
        METRICS,
        f"SELECT corridor_id, event_time, true AS in_expected, {there} AS in_actual,"
        f" {there} AS travel_time_sec_ok, {there} AS free_flow_sec_ok,"
        f" {there} AND corridor_id <> 'ring_road' AS congestion_index_ok, {there} AS speed_kmh_ok,"
        f" {there} AS is_anomaly_ok, {there} AND corridor_id <> 'ring_road' AS matched FROM metrics",
    )

    sql["stream_traffic_windows"] = sql["traffic_windows"]
    sql["stream_vehicle_windows"] = sql["vehicle_windows"]
    sql["stream_weather_clean"] = sql["weather_clean"]
    sql["stream_alerts"] = _query(
        [*STREAM_STEPS, ("raised", "SELECT * FROM flagged WHERE is_anomaly")],
        f"SELECT {_BATCH}, corridor_id, 'congestion_spike' AS alert_type, 'high' AS severity,"
        " congestion_index, speed_kmh, 'High congestion on ' || corridor_id || ': index ' ||"
        f" {_text('congestion_index', 2)} || ', speed ' || {_text('speed_kmh', 1)} || ' km/h' AS message, event_time,"
        f" {_AS_OF} AS created_at FROM raised",
    )
    window = "time_bucket(INTERVAL '10 minutes', event_time)"
    sql["batch_audit"] = _query(
        [
            *STREAM_STEPS,
            ("reads", f"SELECT {_SLICE} AS slice, count(*) AS rows_read FROM traffic GROUP BY 1"),
            ("writes", "SELECT slice, count(*) AS rows_written FROM steps GROUP BY 1"),
        ],
        f"SELECT {_BATCH}, rows_read, rows_written, 0::BIGINT AS late_keys, rows_written AS rows_recorded"
        " FROM reads JOIN writes USING (slice) UNION ALL"
        f" SELECT cast({2 * len(SLICE_BOUNDS) - 2} AS BIGINT), count(*), 0, count(DISTINCT (corridor_id, {window})), 0"
        f" FROM traffic WHERE event_time < TIMESTAMP '{LATE_UNTIL}'",
    )
    sql["alert_delivery"] = _query(
        [*STREAM_STEPS, ("raised", "SELECT * FROM flagged WHERE is_anomaly")],
        f"SELECT {_BATCH}, corridor_id, event_time, 'High congestion on ' || corridor_id || ': index ' ||"
        f" {_text('congestion_index', 2)} || ', speed ' || {_text('speed_kmh', 1)} || ' km/h' AS message,"
        " 1::BIGINT AS times_sent FROM raised",
    )
    sql["stream_latest_per_corridor"] = sql["latest_per_corridor"]
    sql["stream_vehicle_snapshot"] = _query(
        [
            *PINGS,
            *PLACES,
            (
                "newest_pings",
                f"SELECT * REPLACE ({whole} AS event_time) FROM pings QUALIFY row_number() OVER"
                f" (PARTITION BY vehicle_id ORDER BY {whole} DESC, event_id DESC) = 1",
            ),
        ],
        "SELECT event_id, vehicle_id, corridor_id, latitude, longitude, speed_kmh, heading, progress_pct, event_time"
        f" FROM ({_placed('newest_pings')})",
    )
    flaws = ((83, "unknown key"), (97, "no route"), (89, "not json"), (79, "missing value"),
             (103, "zero travel time"), (101, "zero free flow"))
    reason = "CASE " + " ".join(f"WHEN event_id % {n} = 0 THEN '{text}'" for n, text in flaws) + " END"
    sql["document_rejects"] = _query(
        [EV, TIMES, ("judged", f"SELECT *, {reason} AS reason FROM times")],
        "SELECT CASE WHEN reason = 'unknown key' THEN 'elsewhere' ELSE corridor_id END AS key,"
        " event_time AS fetched_at, reason FROM judged WHERE reason IS NOT NULL",
    )
    sql["document_feed"] = _query(
        TRAFFIC_FEED,
        f"SELECT {', '.join(payload)}, travel_time_sec, {whole} AS event_time FROM traffic WHERE {reason} IS NULL",
    )
    return sql
