"""The access-log table: schema and the view over the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S, _L, _I, _D, _B = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.BooleanType(),
)


def access_schema(ts: T.DataType | None = None) -> T.StructType:
    """The 30 input columns; ``ts`` picks the timestamp flavour."""
    fields = [
        ("event_id", _L), ("entity_id", _S), ("entity_type", _S), ("department", _S),
        ("event_ts", ts or T.TimestampNTZType()), ("login_hour", _I), ("is_off_hours", _B),
        ("day_of_week", _S), ("source_ip", _S), ("geo_location", _S),
        ("geo_velocity_kmph", _D), ("resource_accessed", _S), ("resource_type", _S),
        ("resource_sensitivity", _S), ("auth_method", _S), ("login_status", _S),
        ("session_duration_min", _D), ("command_sequence", _S), ("device_fingerprint", _S),
        ("os", _S), ("browser", _S), ("protocol", _S), ("privilege_level", _S),
        ("bytes_uploaded", _L), ("bytes_downloaded", _L), ("failed_attempts", _I),
        ("new_device", _B), ("new_location", _B), ("label", _S), ("anomaly_type", _S),
    ]
    return T.StructType([T.StructField(n, t) for n, t in fields])


EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", _L),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", _L),
        T.StructField("event_type", _S),
        T.StructField("value", _D),
        T.StructField("props", _S),
    ]
)

# Portable between Spark SQL and DuckDB; `{events}` is the source relation.
ACCESS_LOG_SQL = """
WITH b AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k,
         CAST(hour(ts) AS INT) AS h, CAST(day(ts) AS INT) AS dom
  FROM {events}),
c AS (
  SELECT *,
         CASE WHEN k >= 98 THEN CAST((user_id + event_id) % 7 AS INT) ELSE -1 END AS atk,
         CAST((user_id + (k % 3)) % 11 AS INT) AS r,
         CAST(user_id % 10 AS INT) AS u10, CAST(user_id % 20 AS INT) AS u20
  FROM b)
SELECT event_id,
  concat('ent_', lpad(CAST(user_id AS VARCHAR(20)), 6, '0')) AS entity_id,
  CASE u10 WHEN 0 THEN 'Service Account' WHEN 1 THEN 'Edge Device' ELSE 'User' END AS entity_type,
  concat('dept_', lpad(CAST(user_id % 17 AS VARCHAR(20)), 2, '0')) AS department,
  ts AS event_ts,
  h AS login_hour,
  (h < 7 OR h >= 19) AS is_off_hours,
  CASE (dom - 1) % 7 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday'
       WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday' END AS day_of_week,
  concat('10.', CAST(user_id % 256 AS VARCHAR(20)), '.', CAST(event_id % 256 AS VARCHAR(20)), '.1') AS source_ip,
  concat('city_', CAST((CASE WHEN k >= 95 THEN user_id + k ELSE user_id END) % 9 AS VARCHAR(20))) AS geo_location,
  CASE WHEN atk = 2 THEN 2000.0 + value WHEN k >= 95 THEN value * 5 ELSE CAST(0 AS DOUBLE) END AS geo_velocity_kmph,
  concat('res_', lpad(CAST(CASE WHEN atk = 3 THEN CAST(event_id % 11 AS INT) ELSE r END AS VARCHAR(20)), 2, '0')) AS resource_accessed,
  concat('rtype_', CAST(r % 7 AS VARCHAR(20))) AS resource_type,
  CASE WHEN atk = 6 THEN 'Critical' WHEN r % 4 = 0 THEN 'Low' WHEN r % 4 = 1 THEN 'Medium'
       WHEN r % 4 = 2 THEN 'High' ELSE 'Critical' END AS resource_sensitivity,
  CASE k % 5 WHEN 0 THEN 'API_Key' WHEN 1 THEN 'OAuth' WHEN 2 THEN 'Certificate' WHEN 3 THEN 'Password' ELSE 'MFA' END AS auth_method,
  CASE WHEN event_type = 'error' OR atk IN (0, 1) THEN 'Failed' ELSE 'Success' END AS login_status,
  value - CAST(1 AS DOUBLE) AS session_duration_min,
  concat(event_type, '>', CAST(k AS VARCHAR(20))) AS command_sequence,
  concat('dev_', CAST(user_id AS VARCHAR(20)), '_', CAST(CASE WHEN k % 25 = 3 OR atk IN (1, 4) THEN k ELSE 0 END AS VARCHAR(20))) AS device_fingerprint,
  CASE WHEN atk = 4 THEN 'Kali Linux' WHEN u10 = 0 THEN 'Linux-Server' WHEN u10 = 1 THEN 'RTOS-Firmware'
       WHEN user_id % 2 = 0 THEN 'Windows10' ELSE 'Windows11' END AS os,
  CASE WHEN u10 IN (0, 1) THEN NULL WHEN user_id % 3 = 0 THEN 'Chrome' WHEN user_id % 3 = 1 THEN 'Edge' ELSE 'Firefox' END AS browser,
  CASE k % 4 WHEN 0 THEN 'HTTPS' WHEN 1 THEN 'REST' WHEN 2 THEN 'SSH' ELSE 'MQTT' END AS protocol,
  CASE WHEN u10 = 0 THEN 'Service' WHEN u10 = 1 THEN 'Device' WHEN u20 = 5 THEN 'Admin'
       WHEN u20 = 7 THEN 'PowerUser' ELSE 'User' END AS privilege_level,
  CAST(floor(value * 10) AS BIGINT) * (CASE WHEN atk = 5 THEN 20 ELSE 1 END) + 1 AS bytes_uploaded,
  CAST(floor(value * 80) AS BIGINT) + k AS bytes_downloaded,
  CASE WHEN atk = 0 THEN 20 + k % 10 WHEN atk = 1 THEN 8 WHEN event_type = 'error' THEN k % 4 ELSE 0 END AS failed_attempts,
  (k % 25 = 3 OR atk IN (1, 4)) AS new_device,
  k >= 95 AS new_location,
  CASE WHEN atk >= 0 THEN 'Anomaly' ELSE 'Normal' END AS label,
  CASE atk WHEN 0 THEN 'Brute Force' WHEN 1 THEN 'Credential Stuffing' WHEN 2 THEN 'Impossible Travel'
       WHEN 3 THEN 'Lateral Movement' WHEN 4 THEN 'Device Spoofing' WHEN 5 THEN 'Low-and-Slow Exfiltration'
       WHEN 6 THEN 'Insider Drift' ELSE 'Normal' END AS anomaly_type
FROM c
"""


def access_log(events: DataFrame) -> DataFrame:
    """Project an ``events`` table onto the access-log columns."""
    return events.sparkSession.sql(ACCESS_LOG_SQL, events=events)


def read_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_log(spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet"))
