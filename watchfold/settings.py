"""Vocabularies, weights, thresholds and playbooks."""

from __future__ import annotations

# Data-quality expectations.
MISSING_WARNING_PCT = 5.0
MISSING_ERROR_PCT = 50.0
MAX_DUPLICATE_ROWS = 0
EXPECTED_VALUES = {
    "entity_type": ["User", "Service Account", "Edge Device"],
    "label": ["Normal", "Anomaly"],
    "anomaly_type": [
        "Normal",
        "Brute Force",
        "Credential Stuffing",
        "Impossible Travel",
        "Lateral Movement",
        "Device Spoofing",
        "Low-and-Slow Exfiltration",
        "Insider Drift",
    ],
}
ATTACK_TYPES = [t for t in EXPECTED_VALUES["anomaly_type"] if t != "Normal"]
NON_NEGATIVE_COLUMNS = [
    "session_duration_min",
    "bytes_uploaded",
    "bytes_downloaded",
    "failed_attempts",
    "geo_velocity_kmph",
]
CATEGORICAL_COLUMNS = [
    "entity_type",
    "department",
    "day_of_week",
    "geo_location",
    "resource_accessed",
    "resource_type",
    "resource_sensitivity",
    "auth_method",
    "login_status",
    "os",
    "protocol",
    "privilege_level",
    "label",
    "anomaly_type",
]
SAMPLE_VALUES = 8
IQR_FACTOR = 1.5

# Encoding of the model matrix.
ID_COLUMNS = ["event_id", "entity_id", "source_ip", "command_sequence", "device_fingerprint"]
TARGET_COLUMNS = ["label", "anomaly_type"]
BROWSER_DEFAULT = "Not_Applicable"
ORDINAL_LEVELS = {
    "resource_sensitivity": ["Low", "Medium", "High", "Critical"],
    "privilege_level": ["Device", "User", "Service", "PowerUser", "Admin"],
}
LABEL_COLUMNS = ["entity_type", "login_status", "is_off_hours", "new_device", "new_location"]
ONEHOT_COLUMNS = [
    "department",
    "day_of_week",
    "geo_location",
    "resource_type",
    "auth_method",
    "os",
    "protocol",
    "browser",
    "resource_accessed",
]
SCALE_COLUMNS = [
    "login_hour",
    "session_duration_min",
    "bytes_uploaded",
    "bytes_downloaded",
    "failed_attempts",
    "geo_velocity_kmph",
    "hour_sin",
    "hour_cos",
    "time_since_last_login_min",
    "entity_login_count",
    "entity_avg_session",
    "entity_std_session",
    "entity_avg_bytes_up",
    "entity_avg_bytes_down",
    "entity_failed_rate",
    "session_duration_zscore",
    "bytes_uploaded_zscore",
    "bytes_downloaded_zscore",
    "resource_access_entropy",
    "unique_resources_cumulative",
    "unique_locations_cumulative",
    "consecutive_failures",
    "new_device_rate",
    "new_location_rate",
    "peer_avg_session",
    "peer_session_deviation",
    "peer_avg_bytes_up",
    "peer_bytes_up_deviation",
    "peer_avg_bytes_down",
    "peer_bytes_down_deviation",
    "profile_hour_deviation",
    "profile_session_deviation",
    "profile_bytes_up_deviation",
    "profile_new_geo",
    "profile_new_resource",
    "profile_new_device",
]
CALENDAR_COLUMNS = ["is_weekend", "month", "day_of_month"]
ZSCORE_LIMIT = 10.0

# Profiles.
MIN_PROFILE_EVENTS = 5

# Anomaly model.
FOREST_TREES = 200
FOREST_SAMPLE = 256
FOREST_FEATURE_SHARE = 0.8
FOREST_CONTAMINATION = 0.02
FOREST_SEED = 42
LIVE_BOUNDS = (-0.3, 0.2)
ALERT_BUDGET = 0.01

# Attack classifiers.
CV_FOLDS = 5
TOP_IMPORTANCES = 15
RANDOM_FOREST = {"trees": 200, "depth": 15}
BOOSTED = {
    "rounds": 200, "depth": 8, "rate": 0.1, "subsample": 0.8, "columns": 0.8,
    "least_weight": 1.0, "least_rows": 1, "shrink": 1.0, "leaves": 0,
}
BOOSTED_BALANCED = {
    "rounds": 200, "depth": 10, "rate": 0.1, "subsample": 0.8, "columns": 0.8,
    "least_weight": 1e-3, "least_rows": 20, "shrink": 0.0, "leaves": 31,
}

SAMPLE_CLASSES = ["Brute Force", "Device Spoofing"]
SUMMARY_ROWS = 1000

# Risk points, levels and bumps.
RISK_WEIGHTS = {
    "anomaly_confidence": 35,
    "resource_sensitivity": 20,
    "failed_attempts": 10,
    "new_device": 10,
    "new_location": 5,
    "geo_velocity": 5,
    "off_hours": 5,
    "privilege_level": 10,
}
RISK_LEVEL_LIMITS = [("Low", 39), ("Medium", 69), ("High", 89)]
RISK_TOP_LEVEL = "Critical"
ATTACK_BUMP = 15.0
TRAVEL_LIMIT_KMPH = 500

# Response playbooks.
DEFAULT_ACTIONS = {
    "Low": ["Log Event"],
    "Medium": ["Alert SOC Analyst"],
    "High": ["Alert SOC Analyst", "Trigger MFA Challenge"],
    "Critical": ["Alert SOC Analyst", "Disable Account", "Block Origin IP", "Isolate Device"],
}
PLAYBOOKS = {
    "Brute Force": {
        "Medium": ["Alert SOC Analyst", "Rate Limit IP"],
        "High": ["Alert SOC Analyst", "Block Origin IP", "Trigger MFA Challenge"],
        "Critical": ["Alert SOC Analyst", "Disable Account", "Block Origin IP"],
    },
    "Lateral Movement": {
        "Medium": ["Alert SOC Analyst", "Monitor Peer Activity"],
        "High": ["Alert SOC Analyst", "Restrict Subnet Access"],
        "Critical": ["Alert SOC Analyst", "Isolate Device", "Revoke Active Sessions"],
    },
    "Credential Stuffing": {
        "High": ["Alert SOC Analyst", "Block Origin IP", "Force Password Reset"],
        "Critical": ["Alert SOC Analyst", "Disable Account", "Block Origin IP", "Force Password Reset"],
    },
    "Insider Drift": {
        "Medium": ["Alert SOC Analyst", "Notify Manager"],
        "High": ["Alert SOC Analyst", "Notify Manager", "Revoke Highly Privileged Roles"],
        "Critical": ["Alert SOC Analyst", "Disable Account", "Notify HR and Legal"],
    },
    "Impossible Travel": {
        "Medium": ["Alert SOC Analyst", "Trigger MFA Challenge"],
        "High": ["Alert SOC Analyst", "Trigger MFA Challenge", "Revoke Active Sessions"],
        "Critical": ["Alert SOC Analyst", "Disable Account", "Revoke Active Sessions"],
    },
    "Low-and-Slow Exfiltration": {
        "High": ["Alert SOC Analyst", "Throttle Bandwidth"],
        "Critical": ["Alert SOC Analyst", "Block Destination IP", "Disable Account"],
    },
    "Device Spoofing": {
        "High": ["Alert SOC Analyst", "Quarantine Device MAC"],
        "Critical": ["Alert SOC Analyst", "Quarantine Device MAC", "Revoke Certificates"],
    },
}

# Analyst-facing feature names.
FEATURE_NAMES = {
    "session_duration_zscore": "Session duration z-score vs baseline",
    "bytes_uploaded_zscore": "Bytes uploaded z-score vs baseline",
    "bytes_downloaded_zscore": "Bytes downloaded z-score vs baseline",
    "time_since_last_login_min": "Time since last login (minutes)",
    "resource_access_entropy": "Resource access pattern entropy (lateral movement indicator)",
    "consecutive_failures": "Consecutive login failures",
    "profile_hour_deviation": "Login hour deviation from personal baseline",
    "profile_session_deviation": "Session length deviation from personal baseline",
    "profile_bytes_up_deviation": "Data upload deviation from personal baseline",
    "profile_new_geo": "Access from new geographic location",
    "profile_new_resource": "Access to previously unaccessed resource",
    "profile_new_device": "Access from unseen device fingerprint",
    "new_device_rate": "Expanding rate of new device usage",
    "new_location_rate": "Expanding rate of new location usage",
    "peer_session_deviation": "Session duration deviation from department peers",
    "peer_bytes_up_deviation": "Upload data volume deviation from department peers",
    "peer_bytes_down_deviation": "Download data volume deviation from department peers",
    "entity_failed_rate": "Historical failed login ratio",
    "failed_attempts": "Failed login attempt count",
    "geo_velocity_kmph": "Geographic movement velocity (km/h)",
    "privilege_level": "Account privilege tier",
    "resource_sensitivity": "Accessed resource sensitivity tier",
}

# Drift monitoring.
DRIFT_FEATURES = [
    "resource_access_entropy",
    "session_duration_min",
    "bytes_uploaded_zscore",
    "consecutive_failures",
    "hour_sin",
    "profile_hour_deviation",
    "risk_score",
]
DRIFT_P_VALUE = 0.05
DRIFT_DECIMALS = 4
KS_EXACT_ROWS = 10_000
DRIFT_REFERENCE_SHARE = 0.7

# Analyst views.
TRIAGE_MIN_RISK = 50
TRIAGE_ROWS = 500
HIGH_RISK = 75
ALERT_ROWS = 100
TRIAGE_COLUMNS = [
    "event_id",
    "entity_id",
    "entity_type",
    "department",
    "anomaly_type",
    "risk_score",
    "risk_level",
    "risk_contributors",
    "login_hour",
    "is_off_hours",
    "geo_location",
    "resource_accessed",
    "resource_sensitivity",
    "session_duration_min",
    "bytes_uploaded",
    "bytes_downloaded",
    "failed_attempts",
    "geo_velocity_kmph",
]
DETAIL_COLUMNS = [
    "event_id",
    "entity_id",
    "entity_type",
    "department",
    "event_ts",
    "login_hour",
    "is_off_hours",
    "geo_location",
    "resource_accessed",
    "resource_type",
    "resource_sensitivity",
    "auth_method",
    "login_status",
    "session_duration_min",
    "bytes_uploaded",
    "bytes_downloaded",
    "failed_attempts",
    "geo_velocity_kmph",
    "new_device",
    "new_location",
    "protocol",
    "os",
    "browser",
    "privilege_level",
]
PROFILE_METRICS = {
    "session_mean": "Avg Session (min)",
    "bytes_up_mean": "Avg Bytes Uploaded",
    "bytes_down_mean": "Avg Bytes Downloaded",
    "failed_ratio": "Failed Login Rate",
}

# Sizes that decide between physical strategies.
ROWS_PER_SLICE = 1_000_000
LITERAL_VALUES = 512  # values of a column that are written into a plan; more are joined
