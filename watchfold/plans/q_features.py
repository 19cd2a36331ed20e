"""Registered queries: scalars, running features, group statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.operators import encoding, enrich, groups, running
from watchfold.plans import oracle as o
from watchfold.plans.registry import enriched, log, query, r


def _cols(names):
    return [F.col(n) if o.ENRICHED_COLUMNS[n] is None else r(n, o.ENRICHED_COLUMNS[n]) for n in names]


# --- scalars -------------------------------------------------------------------


@query(
    "c01_cyclical_hour",
    o.sql(
        f"SELECT event_id, {o.rd('sin(2 * pi() * login_hour / 24)')} AS hour_sin, "
        f"{o.rd('cos(2 * pi() * login_hour / 24)')} AS hour_cos FROM access_log"
    ),
)
def c01(spark, sf):
    return log(spark, sf).select(
        "event_id", r(sc.hour_sin()).alias("hour_sin"), r(sc.hour_cos()).alias("hour_cos")
    )


@query(
    "c02_weekend",
    o.sql("SELECT event_id, CAST(isodow(event_ts) IN (6, 7) AS INT) AS is_weekend FROM access_log"),
)
def c02(spark, sf):
    return log(spark, sf).select("event_id", sc.is_weekend().alias("is_weekend"))


@query(
    "c03_calendar_parts",
    o.sql(
        "SELECT event_id, CAST(month(event_ts) AS INT) AS month, CAST(day(event_ts) AS INT) AS day_of_month "
        "FROM access_log"
    ),
)
def c03(spark, sf):
    return sc.calendar(log(spark, sf)).select("event_id", "month", "day_of_month")


@query(
    "c04_lenient_parse",
    o.sql(
        "SELECT event_id, epoch_us(try_strptime(CASE WHEN new_device THEN concat('on ', day_of_week) "
        "ELSE strftime(event_ts, '%Y-%m-%d %H:%M:%S') END, '%Y-%m-%d %H:%M:%S')) AS parsed_us FROM access_log"
    ),
)
def c04(spark, sf):
    text = F.when(F.col("new_device"), F.concat(F.lit("on "), "day_of_week")).otherwise(
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss")
    )
    parsed = sc.parse_ts(text, "yyyy-MM-dd HH:mm:ss")
    return log(spark, sf).select("event_id", F.unix_micros(parsed).alias("parsed_us"))


@query(
    "c05_browser_default",
    o.sql("SELECT event_id, coalesce(browser, 'Not_Applicable') AS browser FROM access_log"),
)
def c05(spark, sf):
    return sc.clean_browser(log(spark, sf)).select("event_id", "browser")


@query(
    "c06_clamped_sessions",
    o.sql(
        f"SELECT event_id, {o.rd('greatest(session_duration_min, 0)')} AS session_duration_min FROM access_log"
    ),
)
def c06(spark, sf):
    return sc.clamp_sessions(log(spark, sf)).select("event_id", r("session_duration_min"))


_GAPPY = "CASE WHEN browser IS NULL THEN NULL ELSE {} END"


@query(
    "c07_numeric_nulls",
    o.sql(
        f"SELECT event_id, {o.rd(f'coalesce({_GAPPY.format('session_duration_min')}, 0)')} AS session_duration_min, "
        f"coalesce({_GAPPY.format('bytes_uploaded')}, 0) AS bytes_uploaded FROM access_log"
    ),
)
def c07(spark, sf):
    """Numbers blanked where there is no browser, then filled."""
    blank = lambda c: F.when(F.col("browser").isNotNull(), F.col(c))
    df = log(spark, sf).withColumns({c: blank(c) for c in ("session_duration_min", "bytes_uploaded")})
    return sc.fill_numeric(df).select("event_id", r("session_duration_min"), "bytes_uploaded")


@query(
    "c08_finite",
    o.sql(
        f"SELECT event_id, {o.rd('CASE WHEN geo_velocity_kmph = 0 THEN 0 ELSE session_duration_min / geo_velocity_kmph END')} "
        "AS pace FROM access_log"
    ),
)
def c08(spark, sf):
    """Division that yields infinities and NaN at standstill, made finite."""
    inf, speed = F.lit(float("inf")), F.col("geo_velocity_kmph")
    raw = F.when(speed == 0, F.when(F.col("new_device"), F.lit(float("nan"))).otherwise(inf)).otherwise(
        F.col("session_duration_min") / F.nullif(speed, F.lit(0.0))
    )
    return log(spark, sf).select("event_id", r(sc.finite(raw)).alias("pace"))


@query(
    "c09_clip",
    o.sql(f"SELECT event_id, {o.rd('least(10, greatest(-10, session_duration_min - 50))')} AS clipped FROM access_log"),
)
def c09(spark, sf):
    return log(spark, sf).select("event_id", r(sc.clip(F.col("session_duration_min") - 50)).alias("clipped"))


_KEPT = ["event_id", "entity_type", "department", "login_hour", "resource_type", "bytes_uploaded", "label", "anomaly_type"]


@query("c10_drop_and_split", o.sql(f"SELECT {', '.join(_KEPT)} FROM access_log"))
def c10(spark, sf):
    """Identifiers and raw text leave, targets stay beside the key."""
    df = log(spark, sf)
    features = df.drop(*[c for c in cfg.ID_COLUMNS if c != "event_id"], "event_ts", *cfg.TARGET_COLUMNS)
    targets = df.select("event_id", *cfg.TARGET_COLUMNS)
    return features.join(targets, "event_id").select(*_KEPT)


@query(
    "c11_column_alignment",
    o.sql(
        "SELECT event_id, label, anomaly_type, CAST(bytes_uploaded AS DOUBLE) AS bytes_uploaded, CAST(0 AS DOUBLE) AS absent, "
        "CAST(login_hour AS DOUBLE) AS login_hour FROM access_log"
    ),
)
def c11(spark, sf):
    return encoding.align(log(spark, sf), ["bytes_uploaded", "absent", "login_hour"]).drop("entity_id")


_NAMES = ", ".join(f"('{k}', '{v}')" for k, v in cfg.FEATURE_NAMES.items())
_TITLE = (
    "array_to_string(list_transform(string_split(array_to_string(list_transform(string_split(replace({0}, '_', ' '), ' '), "
    "lambda w: concat(upper(w[1]), lower(w[2:]))), ' '), '-'), lambda w: concat(upper(w[1]), w[2:])), '-')"
)
_HUMAN = ["session_duration_zscore", "entity_login_count", "geo_velocity_kmph", "peer_avg_bytes_up"]


@query(
    "c12_human_names",
    o.sql(
        "SELECT feature, coalesce(h, " + _TITLE.format("feature") + ") AS human_name, n FROM ("
        + " UNION ALL ".join(f"SELECT '{f}' AS feature, count({f}) AS n FROM enriched" for f in _HUMAN)
        + " UNION ALL SELECT concat('used_', anomaly_type), count(*) FROM enriched GROUP BY anomaly_type"
        + f") LEFT JOIN (VALUES {_NAMES}) AS names(k, h) ON k = feature",
        o.ENRICHED,
    ),
)
def c12(spark, sf):
    """Names of features and of attack types, some with hyphens."""
    df = enriched(spark, sf)
    items = F.array(
        *[F.when(F.col(f).isNotNull(), F.lit(f)) for f in _HUMAN], F.concat(F.lit("used_"), "anomaly_type")
    )
    counts = df.select(F.explode(items).alias("feature")).where("feature IS NOT NULL").groupBy("feature").count()
    return counts.select("feature", sc.human_name(F.col("feature")).alias("human_name"), F.col("count").alias("n"))


# --- running features ----------------------------------------------------------

_RUNNING = {
    "d01_time_since_last_login": ["time_since_last_login_min"],
    "d02_login_count": ["entity_login_count"],
    "d03_avg_session": ["entity_avg_session"],
    "d04_std_session": ["entity_std_session"],
    "d05_avg_bytes_up": ["entity_avg_bytes_up"],
    "d06_avg_bytes_down": ["entity_avg_bytes_down"],
    "d07_failed_rate": ["entity_failed_rate"],
    "d08_session_zscore": ["session_duration_zscore"],
    "d09_bytes_up_zscore": ["bytes_uploaded_zscore"],
    "d10_bytes_down_zscore": ["bytes_downloaded_zscore"],
    "d11_consecutive_failures": ["consecutive_failures"],
    "d12_new_device_rate": ["new_device_rate"],
    "d13_new_location_rate": ["new_location_rate"],
}
RUNNING_COLUMNS = [c for cols in _RUNNING.values() for c in cols]


def _running_query(name: str, columns: list[str]) -> None:
    @query(name, o.sql(f"SELECT event_id, {o.enriched_columns(columns)} FROM running", o.RUNNING))
    def run(spark, sf):
        df = log(spark, sf)
        slices = running.fit_entity_slices(df)
        gap = running.fit_median_gap(df, slices) if columns == ["time_since_last_login_min"] else None
        return running.running_features(df, slices, gap).select("event_id", *_cols(columns))


for _name, _columns in _RUNNING.items():
    _running_query(_name, _columns)


@query(
    "d14_running_split",
    o.sql(f"SELECT event_id, {o.enriched_columns(RUNNING_COLUMNS)} FROM running", o.RUNNING),
)
def d14(spark, sf):
    """All running features with every entity cut into slices, as hot entities are."""
    df = log(spark, sf)
    slices = running.fit_entity_slices(df, rows_per_slice=16)
    gap = running.fit_median_gap(df, slices, rows_per_slice=2000)
    return running.running_features(df, slices, gap).select("event_id", *_cols(RUNNING_COLUMNS))


# --- group statistics ----------------------------------------------------------


@query(
    "e01_resource_entropy",
    o.sql(
        f"SELECT event_id, {o.rdas('resource_access_entropy')} FROM access_log LEFT JOIN patterns USING (entity_id)",
        o.PATTERNS,
    ),
)
def e01(spark, sf):
    df = log(spark, sf)
    return groups.attach_access_patterns(df, groups.fit_access_patterns(df)).select(
        "event_id", r("resource_access_entropy")
    )


def _unique_query(name: str, column: str) -> None:
    @query(name, o.sql(f"SELECT event_id, {column} FROM access_log LEFT JOIN uniques USING (entity_id)", o.PATTERNS))
    def run(spark, sf):
        df = log(spark, sf)
        return groups.attach_access_patterns(df, groups.fit_access_patterns(df)).select("event_id", column)


_unique_query("e02_unique_resources", "unique_resources_cumulative")
_unique_query("e03_unique_locations", "unique_locations_cumulative")


def _peer_query(name: str, metric: str, source: str, digits: int) -> None:
    avg, dev = f"peer_avg_{metric}", f"peer_{metric}_deviation"
    text = (
        f"SELECT event_id, {o.rdas(avg, digits)}, {o.rd(f'{source} - {avg}', digits)} AS {dev} "
        "FROM access_log LEFT JOIN peers USING (department)"
    )

    @query(name, o.sql(text, o.PEERS))
    def run(spark, sf):
        df = log(spark, sf)
        return groups.attach_peers(df, groups.fit_peers(df)).select("event_id", r(avg, digits), r(dev, digits))


_peer_query("e04_peer_session", "session", "session_duration_min", 6)
_peer_query("e05_peer_bytes_up", "bytes_up", "bytes_uploaded", 4)
_peer_query("e06_peer_bytes_down", "bytes_down", "bytes_downloaded", 4)


@query(
    "e07_enriched",
    o.sql(f"SELECT event_id, {o.enriched_columns(o.ENRICHED_COLUMNS)} FROM enriched", o.ENRICHED),
)
def e07(spark, sf):
    return enrich.enrich(log(spark, sf)).select("event_id", *_cols(o.ENRICHED_COLUMNS))
