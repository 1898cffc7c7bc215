"""Fixed values and thresholds, all in one place."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Thresholds:
    """Every limit the jobs compare against. All comparisons are strict."""

    # window level: congested above this index, or below this speed
    congestion_index: float = 0.7
    congested_speed_kmh: float = 15.0
    # vehicle window: slow below this speed
    slow_corridor_kmh: float = 20.0
    # single traffic event: anomalous above this unrounded index
    event_index: float = 1.5
    # display bands
    severe_index: float = 0.7
    moderate_index: float = 0.4
    light_index: float = 0.2
    vehicle_slow_kmh: float = 15.0
    vehicle_medium_kmh: float = 30.0
    alert_red_index: float = 0.85
    alert_orange_index: float = 0.7
    # windows and watermarks
    traffic_window: str = "10 minutes"
    vehicle_window: str = "5 minutes"
    watermarks: dict[str, str] = field(
        default_factory=lambda: {
            "traffic": "5 minutes",
            "weather": "10 minutes",
            "vehicle": "2 minutes",
        }
    )
    # time ranges
    baseline_days: int = 7
    freshness_minutes: int = 15
    retention_days: int = 30
    snapshot_ttl_seconds: int = 60
    trend_hours: int = 2
    recent_alerts: int = 20
    map_padding_deg: float = 0.15


DEFAULTS = Thresholds()

EARTH_RADIUS_KM = 6371.0

# --- Fixed values: names and formats shared with the producers of the feeds ---

TOPICS = {
    "traffic": "traffic_events",
    "weather": "weather_events",
    "vehicle": "vehicle_position_events",
}

WEATHER_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"

ALERT_TYPE = "congestion_spike"
ALERT_SEVERITY = "high"

DEFAULT_CITY = "Cairo"
WEATHER_CITIES = ("Cairo", "Alexandria")

# --- Fixed values: monitored corridors ---
# corridor_id, name, city, start_lat, start_lon, end_lat, end_lon, distance_km

CORRIDORS = (
    ("ring_road", "Ring Road", "Cairo", 30.0561, 31.3467, 30.0131, 31.2089, 18.5),
    ("corniche_cairo", "Corniche El Nil", "Cairo", 30.0459, 31.2243, 30.0029, 31.2297, 5.2),
    ("october_bridge", "6th of October Bridge", "Cairo", 30.0554, 31.2235, 30.0434, 31.2015, 3.8),
    ("salah_salem", "Salah Salem Road", "Cairo", 30.0724, 31.2834, 30.0281, 31.2611, 6.1),
    ("july26", "26th of July Corridor", "Cairo", 30.0609, 31.2003, 30.0764, 31.1177, 9.7),
    ("alex_corniche", "Alexandria Corniche", "Alexandria", 31.2135, 29.8854, 31.2017, 29.9533, 7.3),
)

# --- Fixed values: weather locations (name, latitude, longitude) ---

WEATHER_LOCATIONS = (
    ("Cairo", 30.0444, 31.2357),
    ("Alexandria", 31.2001, 29.9187),
)

# --- Fixed values: weather code, description, icon ---

WEATHER_CODES = (
    (0, "Clear sky", "☀️"),
    (1, "Mainly clear", "🌤️"),
    (2, "Partly cloudy", "⛅"),
    (3, "Overcast", "☁️"),
    (45, "Foggy", "🌫️"),
    (48, "Rime fog", "🌫️"),
    (51, "Light drizzle", "🌦️"),
    (53, "Moderate drizzle", "🌦️"),
    (55, "Dense drizzle", "🌧️"),
    (61, "Slight rain", "🌧️"),
    (63, "Moderate rain", "🌧️"),
    (65, "Heavy rain", "⛈️"),
    (80, "Slight showers", "🌦️"),
    (81, "Moderate showers", "🌧️"),
    (82, "Violent showers", "⛈️"),
    (95, "Thunderstorm", "⚡"),
)
UNKNOWN_WEATHER = ("Unknown", "❓")

# --- Fixed values: alert severity colours, and the colour of any other severity ---

SEVERITY_COLORS = (
    ("critical", 0xFF0000),
    ("high", 0xFF4444),
    ("medium", 0xFFA500),
    ("low", 0xFFFF00),
)
DEFAULT_SEVERITY_COLOR = 0xFF4444

# --- Fixed values: congestion bands, their colours, and status icons ---

BAND_SEVERE, BAND_MODERATE, BAND_LIGHT, BAND_FREE = "Severe", "Moderate", "Light", "Free Flow"
COLOR_RED, COLOR_ORANGE, COLOR_YELLOW, COLOR_GREEN = "#FF4444", "#FFA500", "#FFD700", "#00D4AA"
ICON_RED, ICON_ORANGE, ICON_YELLOW, ICON_GREEN = "🔴", "🟠", "🟡", "🟢"

# --- Fixed values: labels of an alert card's fields, and whether they share a line ---

CARD_FIELDS = (
    ("corridor_field", "🛣️ Corridor", True),
    ("index_field", "📊 Congestion Index", True),
    ("speed_field", "🏎️ Speed", True),
    ("time_field", "⏰ Event Time", False),
)
CARD_FOOTER = "Congestion Intelligence"
