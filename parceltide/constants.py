"""Fixed values of the control tower: thresholds, vocabularies and seed rows."""

# --- fixed values: delay bands, alert threshold and severity limits (minutes) ---
LOW_MAX_MIN = 15
MEDIUM_MAX_MIN = 60
ALERT_THRESHOLD_MIN = 15.0
SEVERITY_LIMITS = (("critical", 120), ("high", 60), ("medium", 30))
SEVERITY_FLOOR = "low"

# --- fixed values: event vocabulary ---
STATUS_BY_EVENT = {
    "accepted": "accepted",
    "pickup": "picked_up",
    "in_transit": "in_transit",
    "delivered": "delivered",
}
INITIAL_STATUS = "planned"
PLAN_TOPIC = "planned_shipments"
EVENT_TOPIC = "delivery_events"
ALERT_TOPIC = "alerts"
ERROR_TOPIC = "error_logs"
ALERT_TYPE = "delay_detected"
UNKNOWN_PARCEL = "unknown_parcel"

# --- fixed values: dashboard ---
SLA_TARGET_PCT = 95.0
HUB_RED_ABOVE_HIGH = 5
HUB_ORANGE_ABOVE_MEDIUM = 10
KNOWN_SEVERITIES = ("critical", "high", "medium", "low")
MESSAGE_DISPLAY_CHARS = 80
TIMESTAMP_DISPLAY_CHARS = 19
DEFAULT_LIMIT = 20
CONTEXT_MESSAGES = 6

# --- fixed values: weather and route risk parameters ---
WEATHER_FACTOR = {"clear": 1.0, "rain": 1.3, "fog": 1.2, "snow": 1.8, "storm": 2.5}
WEATHER_RISK = {"clear": 0.0, "rain": 0.3, "fog": 0.2, "snow": 0.8, "storm": 1.5}
DEFAULT_WEATHER = "clear"
DEFAULT_WEATHER_FACTOR = 1.0
DEFAULT_CONGESTION = 0.3
DEFAULT_ROUTE_RISK = 0.4
DEFAULT_DISTANCE_KM = 400.0
DEFAULT_ROUTE = "R_PAR_LYO"
DEFAULT_WEIGHT_KG = 5.0
FALLBACK_SPEED_KMH = 80.0
HEURISTIC_LOW_BELOW = 0.35
HEURISTIC_MEDIUM_BELOW = 0.65
ROUTE_RISK = {
    "R_PAR_MAR": 0.6,
    "R_PAR_LYO": 0.4,
    "R_PAR_BOR": 0.45,
    "R_PAR_LIL": 0.3,
    "R_LYO_MAR": 0.5,
    "R_PAR_NAN": 0.35,
    "R_PAR_STR": 0.4,
}

# --- fixed values: seed rows of the dimensions ---
# hub_id, hub_name, city, latitude, longitude, capacity
HUB_SEED = [
    ("HUB_PARIS", "Paris CDG", "Paris", 48.8566, 2.3522, 5000),
    ("HUB_LYON", "Lyon Sud", "Lyon", 45.7640, 4.8357, 3000),
    ("HUB_MARSEILLE", "Marseille Fos", "Marseille", 43.2965, 5.3698, 2500),
    ("HUB_BORDEAUX", "Bordeaux Nord", "Bordeaux", 44.8378, -0.5792, 2000),
    ("HUB_LILLE", "Lille Nord", "Lille", 50.6292, 3.0573, 2000),
    ("HUB_NANTES", "Nantes Atlantique", "Nantes", 47.2184, -1.5536, 1800),
    ("HUB_STRASBOURG", "Strasbourg Est", "Strasbourg", 48.5734, 7.7521, 1500),
]
# route_id, origin city, destination city, distance_km, avg_duration_h
ROUTE_SEED = [
    ("R_PAR_LYO", "Paris", "Lyon", 465.0, 4.5),
    ("R_PAR_MAR", "Paris", "Marseille", 775.0, 7.5),
    ("R_PAR_BOR", "Paris", "Bordeaux", 585.0, 6.0),
    ("R_PAR_LIL", "Paris", "Lille", 225.0, 2.5),
    ("R_LYO_MAR", "Lyon", "Marseille", 315.0, 3.5),
    ("R_PAR_NAN", "Paris", "Nantes", 385.0, 4.0),
    ("R_PAR_STR", "Paris", "Strasbourg", 490.0, 5.0),
]
# client_id, client_name, sla_hours, priority
CLIENT_SEED = [
    ("CLIENT_A", "Carrefour Logistique", 24.0, 1),
    ("CLIENT_B", "Amazon FR", 12.0, 1),
    ("CLIENT_C", "Leroy Merlin", 48.0, 2),
    ("CLIENT_D", "Decathlon Express", 36.0, 2),
    ("CLIENT_E", "FNAC Direct", 24.0, 1),
]

# --- fixed values: order of the feature vector ---
FEATURE_COLUMNS = [
    "route_enc", "weather_enc", "client_enc", "hub_enc",
    "congestion_level", "distance_km", "weight_kg",
    "hour_of_day", "day_of_week", "is_weekend", "planned_duration_h",
    "weather_congestion", "distance_per_hour", "high_congestion",
    "severe_weather", "heavy_parcel",
    "weather_rain", "weather_fog", "weather_snow", "weather_storm",
    "congestion_sq", "weather_risk_score", "composite_risk",
]
RISK_CLASSES = ("low", "medium", "high")
