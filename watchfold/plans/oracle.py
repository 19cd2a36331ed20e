"""SQL building blocks of the twins of the registered queries (checked in DuckDB)."""

from __future__ import annotations

from watchfold import settings as cfg
from watchfold.sources.access_log import ACCESS_LOG_SQL

LOG = f"access_log AS ({ACCESS_LOG_SQL.format(events='events')})"


def sql(query: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([LOG, *ctes]) + "\n" + query


def rd(expr: str, digits: int = 6) -> str:
    """Rounded double without negative zero."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"


def half_up(expr: str, digits: int) -> str:
    """Rounded on the printed decimals, ties away from zero."""
    return f"CAST(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(30, {digits})) AS DOUBLE)"


def rdas(name: str, digits: int = 6) -> str:
    return f"{rd(name, digits)} AS {name}"


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


FAILED = "(CASE WHEN login_status = 'Failed' THEN 1 ELSE 0 END)"

RUNNING = f"""
run0 AS (
  SELECT *,
    row_number() OVER w AS entity_login_count,
    (epoch_us(event_ts) - lag(epoch_us(event_ts)) OVER w) / CAST(60000000 AS DOUBLE) AS gap,
    avg(session_duration_min) OVER u AS entity_avg_session,
    coalesce(stddev_samp(session_duration_min) OVER u, 0) AS entity_std_session,
    avg(bytes_uploaded) OVER u AS entity_avg_bytes_up,
    avg(bytes_downloaded) OVER u AS entity_avg_bytes_down,
    stddev_samp(bytes_uploaded) OVER u AS sd_up,
    stddev_samp(bytes_downloaded) OVER u AS sd_down,
    avg({FAILED}) OVER u AS entity_failed_rate,
    avg(CAST(new_device AS INT)) OVER u AS new_device_rate,
    avg(CAST(new_location AS INT)) OVER u AS new_location_rate,
    sum(1 - {FAILED}) OVER u AS island
  FROM access_log
  WINDOW w AS (PARTITION BY entity_id ORDER BY event_ts, event_id),
         u AS (PARTITION BY entity_id ORDER BY event_ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
med AS (SELECT median(gap) AS median_gap FROM run0),
running AS (
  SELECT run0.*,
    coalesce(gap, median_gap) AS time_since_last_login_min,
    least(10, greatest(-10, (session_duration_min - entity_avg_session)
      / (CASE WHEN entity_std_session = 0 THEN 1 ELSE entity_std_session END))) AS session_duration_zscore,
    least(10, greatest(-10, (bytes_uploaded - entity_avg_bytes_up)
      / coalesce(nullif(sd_up, 0), 1))) AS bytes_uploaded_zscore,
    least(10, greatest(-10, (bytes_downloaded - entity_avg_bytes_down)
      / coalesce(nullif(sd_down, 0), 1))) AS bytes_downloaded_zscore,
    CAST(sum({FAILED}) OVER (PARTITION BY entity_id, island ORDER BY event_ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS consecutive_failures
  FROM run0, med)"""

PATTERNS = """
res_counts AS (
  SELECT entity_id, resource_accessed, count(*) AS n FROM access_log
  WHERE resource_accessed IS NOT NULL GROUP BY ALL),
res_shares AS (SELECT entity_id, n / CAST(sum(n) OVER (PARTITION BY entity_id) AS DOUBLE) AS p FROM res_counts),
patterns AS (
  SELECT entity_id, -sum(p * log2(greatest(p, 1e-10))) AS resource_access_entropy
  FROM res_shares GROUP BY entity_id),
uniques AS (
  SELECT entity_id, count(DISTINCT resource_accessed) AS unique_resources_cumulative,
         count(DISTINCT geo_location) AS unique_locations_cumulative
  FROM access_log GROUP BY entity_id)"""

PEERS = """
peers AS (
  SELECT department, avg(session_duration_min) AS peer_avg_session, avg(bytes_uploaded) AS peer_avg_bytes_up,
         avg(bytes_downloaded) AS peer_avg_bytes_down
  FROM access_log GROUP BY department)"""

ENRICHED = f"""{RUNNING},{PATTERNS},{PEERS},
enriched AS (
  SELECT running.*,
    sin(2 * pi() * login_hour / 24) AS hour_sin, cos(2 * pi() * login_hour / 24) AS hour_cos,
    CAST(isodow(event_ts) IN (6, 7) AS INT) AS is_weekend,
    CAST(month(event_ts) AS INT) AS month, CAST(day(event_ts) AS INT) AS day_of_month,
    resource_access_entropy, unique_resources_cumulative, unique_locations_cumulative,
    peer_avg_session, session_duration_min - peer_avg_session AS peer_session_deviation,
    peer_avg_bytes_up, bytes_uploaded - peer_avg_bytes_up AS peer_bytes_up_deviation,
    peer_avg_bytes_down, bytes_downloaded - peer_avg_bytes_down AS peer_bytes_down_deviation
  FROM running LEFT JOIN patterns USING (entity_id) LEFT JOIN uniques USING (entity_id)
       LEFT JOIN peers USING (department))"""

ENRICHED_COLUMNS = {
    "hour_sin": 6, "hour_cos": 6, "is_weekend": None, "month": None, "day_of_month": None,
    "time_since_last_login_min": 8, "entity_login_count": None, "entity_avg_session": 8,
    "entity_std_session": 6, "entity_avg_bytes_up": 4, "entity_avg_bytes_down": 4, "entity_failed_rate": 6,
    "session_duration_zscore": 6, "bytes_uploaded_zscore": 6, "bytes_downloaded_zscore": 6,
    "resource_access_entropy": 6, "unique_resources_cumulative": None, "unique_locations_cumulative": None,
    "consecutive_failures": None, "new_device_rate": 6, "new_location_rate": 6,
    "peer_avg_session": 6, "peer_session_deviation": 6, "peer_avg_bytes_up": 4,
    "peer_bytes_up_deviation": 4, "peer_avg_bytes_down": 4, "peer_bytes_down_deviation": 4,
}


def enriched_columns(names) -> str:
    return ", ".join(n if ENRICHED_COLUMNS[n] is None else rdas(n, ENRICHED_COLUMNS[n]) for n in names)


def mode_of(column: str, key: str, source: str) -> str:
    """Most frequent value per key, ties to the smallest."""
    return (
        f"SELECT {key}, {column} AS v FROM (SELECT {key}, {column}, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY count(*) DESC, {column}) AS rk FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY {key}, {column}) WHERE rk = 1"
    )


def profile_cte(name: str, key: str, source: str) -> str:
    """Scalar profiles per key."""
    return f"""
{name}_hour AS ({mode_of('login_hour', key, source)}),
{name}_geo AS ({mode_of('geo_location', key, source)}),
{name}_res AS ({mode_of('resource_accessed', key, source)}),
{name}_priv AS ({mode_of('privilege_level', key, source)}),
{name}_base AS (
  SELECT {key}, count(*) AS event_count,
    avg(login_hour) AS login_hour_mean, stddev_pop(login_hour) AS login_hour_std,
    avg(session_duration_min) AS session_mean, stddev_pop(session_duration_min) AS session_std,
    median(session_duration_min) AS session_median,
    avg(bytes_uploaded) AS bytes_up_mean, stddev_pop(bytes_uploaded) AS bytes_up_std,
    avg(bytes_downloaded) AS bytes_down_mean, stddev_pop(bytes_downloaded) AS bytes_down_std,
    avg({FAILED}) AS failed_ratio,
    count(DISTINCT geo_location) AS n_geo_locations, count(DISTINCT device_fingerprint) AS n_devices,
    count(DISTINCT resource_accessed) AS n_resources, count(DISTINCT protocol) AS n_protocols,
    count(DISTINCT auth_method) AS n_auth_methods,
    arg_min(department, event_ts) AS first_department
  FROM {source} GROUP BY {key}),
{name} AS (
  SELECT b.*, h.v AS login_hour_mode, g.v AS geo_location_mode, r.v AS resource_mode, p.v AS privilege_mode
  FROM {name}_base b LEFT JOIN {name}_hour h USING ({key}) LEFT JOIN {name}_geo g USING ({key})
       LEFT JOIN {name}_res r USING ({key}) LEFT JOIN {name}_priv p USING ({key}))"""


PROFILE_COLUMNS = {
    "event_count": None, "login_hour_mean": 6, "login_hour_std": 6, "login_hour_mode": None,
    "geo_location_mode": None, "resource_mode": None, "privilege_mode": None,
    "session_mean": 8, "session_std": 6, "session_median": 8, "bytes_up_mean": 4, "bytes_up_std": 4,
    "bytes_down_mean": 4, "bytes_down_std": 4, "failed_ratio": 6, "n_geo_locations": None, "n_devices": None,
    "n_resources": None, "n_protocols": None, "n_auth_methods": None,
}


def profile_columns() -> str:
    return ", ".join(n if d is None else rdas(n, d) for n, d in PROFILE_COLUMNS.items())


RULE_SCORE = (
    "least(CAST(100 AS DOUBLE), CAST(failed_attempts AS DOUBLE) * 4 + geo_velocity_kmph / CAST(37 AS DOUBLE)"
    " + CAST(bytes_uploaded AS DOUBLE) / CAST(411 AS DOUBLE))"
)
RULE_DECISION = f"(CAST(0.25 AS DOUBLE) - {RULE_SCORE} / CAST(100 AS DOUBLE))"
RULE_CLASS = """(CASE WHEN os = 'Kali Linux' THEN 'Device Spoofing' WHEN failed_attempts >= 20 THEN 'Brute Force'
  WHEN failed_attempts = 8 THEN 'Credential Stuffing' WHEN geo_velocity_kmph > 2000 THEN 'Impossible Travel'
  WHEN bytes_uploaded > 2000 THEN 'Low-and-Slow Exfiltration'
  WHEN resource_sensitivity = 'Critical' THEN 'Insider Drift' ELSE 'Lateral Movement' END)"""

D = "CAST({} AS DOUBLE)".format
CONF = "(s / CAST(100 AS DOUBLE) * CAST(35 AS DOUBLE))"
# rule -> (points, contributor text)
RISK_TERMS = {
    "anomaly": (
        f"{CONF}",
        f"CASE WHEN {CONF} >= 17.5 THEN concat('+', CAST(trunc({CONF}) AS INT), ' High anomaly confidence') "
        f"WHEN {CONF} > 0 THEN concat('+', CAST(trunc({CONF}) AS INT), ' Moderate anomaly confidence') END",
    ),
    "resource": (
        "CASE lower(resource_sensitivity) WHEN 'critical' THEN 20 WHEN 'high' THEN 15 WHEN 'medium' THEN 5 ELSE 0 END",
        "CASE lower(resource_sensitivity) WHEN 'critical' THEN '+20 Critical resource' "
        "WHEN 'high' THEN '+15 High sensitivity resource' END",
    ),
    "privilege": (
        "CASE lower(privilege_level) WHEN 'admin' THEN 10 WHEN 'poweruser' THEN 7 WHEN 'service' THEN 5 ELSE 0 END",
        "CASE lower(privilege_level) WHEN 'admin' THEN '+10 Admin privilege' "
        "WHEN 'poweruser' THEN '+7 PowerUser privilege' END",
    ),
    "off_hours": ("CASE WHEN is_off_hours THEN 5 ELSE 0 END", "CASE WHEN is_off_hours THEN '+5 Off-hours login' END"),
    "new_device": ("CASE WHEN new_device THEN 10 ELSE 0 END", "CASE WHEN new_device THEN '+10 New device' END"),
    "new_location": ("CASE WHEN new_location THEN 5 ELSE 0 END", "CASE WHEN new_location THEN '+5 New location' END"),
    "failures": (
        "CASE WHEN failed_attempts > 0 THEN least(failed_attempts / CAST(5 AS DOUBLE), 1) * 10 ELSE 0 END",
        "CASE WHEN failed_attempts >= 3 THEN concat('+', "
        "CAST(trunc(least(failed_attempts / CAST(5 AS DOUBLE), 1) * 10) AS INT), "
        "' Multiple failed attempts (', failed_attempts, ')') END",
    ),
    "travel": (
        "CASE WHEN geo_velocity_kmph > 500 THEN 5 ELSE 0 END",
        "CASE WHEN geo_velocity_kmph > 500 THEN concat('+5 Impossible travel (', "
        "CAST(trunc(geo_velocity_kmph) AS BIGINT), ' km/h)') END",
    ),
    "attack": (
        "CASE WHEN anomaly_type <> 'Normal' THEN 15 ELSE 0 END",
        "CASE WHEN anomaly_type <> 'Normal' THEN concat('+15 Suspected ', anomaly_type, ' attack pattern') END",
    ),
}
_POINTS = " + ".join(f"({D(p)})" for p, _ in RISK_TERMS.values())
_TEXTS = ", ".join(t for _, t in RISK_TERMS.values())
LEVEL = "(CASE WHEN {0} <= 39 THEN 'Low' WHEN {0} <= 69 THEN 'Medium' WHEN {0} <= 89 THEN 'High' ELSE 'Critical' END)"
SCORED = f"""
scored0 AS (SELECT *, {RULE_SCORE} AS s, {RULE_DECISION} AS decision FROM access_log),
scored1 AS (
  SELECT *, least(CAST(100 AS DOUBLE), greatest(CAST(0 AS DOUBLE), {_POINTS})) AS raw_risk,
         concat_ws(' | ', {_TEXTS}) AS risk_contributors
  FROM scored0),
scored AS (
  SELECT *, s AS anomaly_score, round(raw_risk, 2) AS risk_score, {LEVEL.format('raw_risk')} AS risk_level,
         CASE WHEN decision < 0 THEN -1 ELSE 1 END AS prediction,
         CASE WHEN decision < 0 THEN 1 ELSE 0 END AS is_anomaly
  FROM scored1)"""

PLAYBOOKS = (
    "playbook(t, lv, acts) AS (VALUES "
    + ", ".join(
        f"('{t}', '{lv}', '{'; '.join(a)}')" for t, levels in cfg.PLAYBOOKS.items() for lv, a in levels.items()
    )
    + "),\ndefaults(dlv, dacts) AS (VALUES "
    + ", ".join(f"('{lv}', '{'; '.join(a)}')" for lv, a in cfg.DEFAULT_ACTIONS.items())
    + ")"
)
ACTIONS = f"""{PLAYBOOKS},
acted AS (
  SELECT scored.*, CASE WHEN risk_level = 'Low' OR anomaly_type = 'Normal' THEN 'Log Event'
         ELSE coalesce(acts, dacts, '') END AS actions
  FROM scored LEFT JOIN playbook ON t = anomaly_type AND lv = risk_level LEFT JOIN defaults ON dlv = risk_level)"""
