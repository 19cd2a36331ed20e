"""Registered queries: look-back features."""

from __future__ import annotations

from watchfold.operators import rolling
from watchfold.plans import oracle as o
from watchfold.plans.registry import log, query, r


def _frame(days: int) -> str:
    return (
        f"OVER (PARTITION BY entity_id ORDER BY event_ts RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND CURRENT ROW)"
    )


_WEEK = _frame(7)


@query(
    "x01_login_frequency",
    o.sql(
        f"SELECT event_id, count(*) {_WEEK} AS login_frequency_7d, count(*) {_frame(30)} AS login_frequency_30d FROM access_log"
    ),
)
def x01(spark, sf):
    df = log(spark, sf)
    week, month = rolling.rolling_rates(df, 7), rolling.rolling_rates(df, 30)
    return week.select("event_id", "login_frequency_7d").join(
        month.select("event_id", "login_frequency_30d"), "event_id"
    )


@query(
    "x02_unique_values",
    o.sql(
        f"SELECT event_id, count(DISTINCT resource_accessed) {_WEEK} AS unique_resources_7d, "
        f"count(DISTINCT geo_location) {_WEEK} AS unique_locations_7d FROM access_log"
    ),
)
def x02(spark, sf):
    df = log(spark, sf)
    resources = rolling.rolling_distinct(df, "resource_accessed", "unique_resources_7d", 7)
    return resources.join(rolling.rolling_distinct(df, "geo_location", "unique_locations_7d", 7), "event_id")


@query(
    "x03_failed_ratio",
    o.sql(f"SELECT event_id, {o.rd(f'avg({o.FAILED}) {_WEEK}')} AS failed_login_ratio_7d FROM access_log"),
)
def x03(spark, sf):
    return rolling.rolling_rates(log(spark, sf), 7).select("event_id", r("failed_login_ratio_7d"))


_X04 = o.sql(
    f"SELECT event_id, {o.rd(f'avg(CAST(new_device AS INT)) {_WEEK}')} AS new_device_rate_7d, "
    f"{o.rd(f'avg(CAST(new_location AS INT)) {_WEEK}')} AS new_location_rate_7d FROM access_log"
)


@query("x04_novelty_rates", _X04)
def x04(spark, sf):
    return rolling.rolling_rates(log(spark, sf), 7).select("event_id", r("new_device_rate_7d"), r("new_location_rate_7d"))


@query("x04_novelty_rates_split", _X04)
def x04_split(spark, sf):
    out = rolling.rolling_rates(log(spark, sf), 7, rows_per_slice=20)
    return out.select("event_id", r("new_device_rate_7d"), r("new_location_rate_7d"))


@query(
    "x05_entropy_to_date",
    o.sql(
        f"SELECT event_id, {o.rd('-sum(n / total * log2(n / total))')} AS resource_access_entropy_to_date FROM ("
        "SELECT event_id, CAST(n AS DOUBLE) AS n, CAST(sum(n) OVER (PARTITION BY event_id) AS DOUBLE) AS total FROM ("
        "SELECT a.event_id, b.resource_accessed, count(*) AS n FROM access_log a JOIN access_log b "
        "ON a.entity_id = b.entity_id AND b.event_ts <= a.event_ts GROUP BY a.event_id, b.resource_accessed)) GROUP BY event_id"
    ),
)
def x05(spark, sf):
    return rolling.expanding_entropy(log(spark, sf)).select("event_id", r("resource_access_entropy_to_date"))
