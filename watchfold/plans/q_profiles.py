"""Registered queries: profiles, deviations, encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators import classify as cl
from watchfold.operators import encoding, profiles
from watchfold.plans import oracle as o
from watchfold.plans.q_sources import CODES
from watchfold.session import keep
from watchfold.plans.registry import (
    CUTOFF, early, fitted_profiles, late, log, profiled, query, r, shared,
)

# With this many events required, a good part of the entities counts as new.
MIN_EVENTS = 66


def _profile_columns():
    return [F.col(c) if d is None else r(c, d) for c, d in o.PROFILE_COLUMNS.items()]


_ENTITY = o.profile_cte("ent", "entity_id", "access_log")
_DEPT = o.profile_cte("dept", "department", "access_log")


@query("f01_entity_profiles", o.sql(f"SELECT entity_id, {o.profile_columns()} FROM ent", _ENTITY))
def f01(spark, sf):
    df = log(spark, sf)
    counted = profiles.count_values(df, "entity_id")
    return profiles.build_profiles(df, "entity_id", counted).select("entity_id", *_profile_columns())


_SET_SQL = " UNION ALL ".join(
    f"SELECT DISTINCT concat('{kind}:', {key}) AS owner, '{name}' AS set_name, {c} AS value FROM access_log "
    f"WHERE {c} IS NOT NULL"
    for kind, key in (("entity", "entity_id"), ("department", "department"))
    for name, c in profiles.SETS.items()
)


@query("f01_profile_sets", o.sql(_SET_SQL))
def f01_sets(spark, sf):
    return profiles.profile_sets(fitted_profiles(spark, sf))


@query("f02_department_profiles", o.sql(f"SELECT department, {o.profile_columns()} FROM dept", _DEPT))
def f02(spark, sf):
    return fitted_profiles(spark, sf).department.select("department", *_profile_columns())


_COLD = "e.event_count < {0} AND d.department IS NOT NULL".format(MIN_EVENTS)
_FALLBACK = ", ".join(
    (lambda v: f"{v} AS {c}" if dg is None else f"{o.rd(v, dg)} AS {c}")(
        f"CASE WHEN {_COLD} THEN d.{c} ELSE e.{c} END"
    )
    for c, dg in o.PROFILE_COLUMNS.items()
)


@query(
    "f03_cold_start",
    o.sql(
        f"SELECT entity_id, {_FALLBACK}, e.event_count < {MIN_EVENTS} AS cold_start, "
        f"CASE WHEN {_COLD} THEN d.department END AS fallback_department "
        "FROM ent e LEFT JOIN dept d ON d.department = e.first_department",
        _ENTITY,
        _DEPT,
    ),
)
def f03(spark, sf):
    prof = profiles.fit_profiles(log(spark, sf), min_events=MIN_EVENTS)
    return prof.entity.select("entity_id", *_profile_columns(), "cold_start", "fallback_department")


def _apply_sql(fit: str, rows: str, min_events: int) -> str:
    """Deviations of ``rows`` from profiles of ``fit`` (both conditions on the log)."""
    def z(source: str, p: str) -> str:
        return f"coalesce(abs({source} - {p}_mean) / coalesce(nullif({p}_std, 0), 1), 0)"

    def fresh(c: str) -> str:
        return (
            f"CASE WHEN p.entity_id IS NULL THEN 0 WHEN {c} IS NULL THEN 1 "
            f"WHEN p.fallback IS NULL AND EXISTS (SELECT 1 FROM fitted f WHERE f.entity_id = s.entity_id AND f.{c} = s.{c}) THEN 0 "
            f"WHEN p.fallback IS NOT NULL AND EXISTS (SELECT 1 FROM fitted f WHERE f.department = p.fallback AND f.{c} = s.{c}) THEN 0 "
            "ELSE 1 END"
        )

    stats = ", ".join(
        f"CASE WHEN e.event_count < {min_events} AND d.department IS NOT NULL THEN d.{p}_{m} ELSE e.{p}_{m} END AS {p}_{m}"
        for p in ("login_hour", "session", "bytes_up")
        for m in ("mean", "std")
    )
    ctes = f"""
fitted AS (SELECT * FROM access_log WHERE {fit}),
late_rows AS (SELECT * FROM access_log WHERE {rows}),
{o.profile_cte('ent', 'entity_id', 'fitted').strip()},
{o.profile_cte('dept', 'department', 'fitted').strip()},
prof AS (
  SELECT e.entity_id, {stats},
    CASE WHEN e.event_count < {min_events} AND d.department IS NOT NULL THEN d.department END AS fallback
  FROM ent e LEFT JOIN dept d ON d.department = e.first_department)"""
    return o.sql(
        f"SELECT event_id, {o.rd(z('login_hour', 'login_hour'))} AS profile_hour_deviation, "
        f"{o.rd(z('session_duration_min', 'session'))} AS profile_session_deviation, "
        f"{o.rd(z('bytes_uploaded', 'bytes_up'))} AS profile_bytes_up_deviation, "
        f"{fresh('geo_location')} AS profile_new_geo, {fresh('resource_accessed')} AS profile_new_resource, "
        f"{fresh('device_fingerprint')} AS profile_new_device "
        "FROM late_rows s LEFT JOIN prof p USING (entity_id)",
        ctes,
    )


_ZS = list(profiles.DEVIATIONS)
_NEW = list(profiles.NOVELTIES)
_EARLY, _LATE = f"event_ts < TIMESTAMP '{CUTOFF}'", f"event_ts >= TIMESTAMP '{CUTOFF}'"


def _late_deviations(spark, sf, min_events: int):
    df = log(spark, sf)
    fitted = shared(spark, sf, f"early-profiles-{min_events}", lambda: profiles.fit_profiles(early(df), min_events))
    return profiles.apply_profiles(late(df), fitted).select("event_id", *[r(c) for c in _ZS], *_NEW)


@query(
    "f04_late_deviations",
    f"SELECT event_id, {', '.join(_ZS)} FROM ({_apply_sql(_EARLY, _LATE, cfg.MIN_PROFILE_EVENTS)})",
)
def f04(spark, sf):
    """Profiles of the first 20 days, deviations of the rest."""
    return _late_deviations(spark, sf, cfg.MIN_PROFILE_EVENTS).select("event_id", *_ZS)


@query(
    "f05_late_novelties",
    f"SELECT event_id, {', '.join(_NEW)} FROM ({_apply_sql(_EARLY, _LATE, cfg.MIN_PROFILE_EVENTS)})",
)
def f05(spark, sf):
    return _late_deviations(spark, sf, cfg.MIN_PROFILE_EVENTS).select("event_id", *_NEW)


@query("f05_novelties_cold_start", _apply_sql(_EARLY, _LATE, 44))
def f05_cold(spark, sf):
    """The same where many entities borrow their department's profile."""
    return _late_deviations(spark, sf, 44)


@query("f06_fit_and_apply", _apply_sql("TRUE", "TRUE", cfg.MIN_PROFILE_EVENTS))
def f06(spark, sf):
    return profiles.apply_profiles(log(spark, sf), fitted_profiles(spark, sf)).select(
        "event_id", *[r(c) for c in _ZS], *_NEW
    )


# --- encoders ------------------------------------------------------------------


def _case(column: str, levels) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(levels)) + " ELSE -1 END"


@query(
    "g01_ordinal",
    o.sql(
        "SELECT event_id, "
        + ", ".join(f"CAST({_case(c, lv)} AS DOUBLE) AS {c}" for c, lv in cfg.ORDINAL_LEVELS.items())
        + " FROM access_log"
    ),
)
def g01(spark, sf):
    return log(spark, sf).select("event_id", *[encoding.ordinal(c).alias(c) for c in cfg.ORDINAL_LEVELS])


def _text_sql(c: str) -> str:
    return f"CASE WHEN {c} THEN 'True' ELSE 'False' END" if c in ("is_off_hours", "new_device", "new_location") else c


_LABELLED = ", ".join(
    f"(SELECT code FROM codes WHERE column_name = '{c}' AND value = {_text_sql(c)}) AS {c}" for c in cfg.LABEL_COLUMNS
)


@query("g02_label_codes", o.sql(f"SELECT event_id, {_LABELLED} FROM access_log", CODES))
def g02(spark, sf):
    df = encoding.prepare(log(spark, sf))
    cats = encoding.Encoder(encoding.fit_codes(df), None).categories()
    return df.select("event_id", *[encoding.label_code(df, c, cats[c]).alias(c) for c in cfg.LABEL_COLUMNS])


_SEEN_EARLY = (
    "seen AS (SELECT login_status AS value, CAST(row_number() OVER (ORDER BY login_status) - 1 AS INT) AS code "
    "FROM (SELECT DISTINCT login_status FROM access_log WHERE entity_type = 'Edge Device' AND login_status = 'Success')), "
    "towns AS (SELECT geo_location AS value, CAST(row_number() OVER (ORDER BY geo_location) - 1 AS INT) AS code "
    "FROM (SELECT DISTINCT geo_location FROM access_log WHERE department IN ('dept_00', 'dept_01') AND NOT new_location))"
)


@query(
    "g03_unseen_labels",
    o.sql(
        "SELECT event_id, coalesce(seen.code, -1) AS login_status, coalesce(towns.code, -1) AS geo_location "
        "FROM access_log LEFT JOIN seen ON seen.value = login_status LEFT JOIN towns ON towns.value = geo_location",
        _SEEN_EARLY,
    ),
)
def g03(spark, sf):
    """Codes fitted on some rows, replayed on all: values not seen get -1."""
    df = log(spark, sf)
    status = df.where((F.col("entity_type") == "Edge Device") & (F.col("login_status") == "Success"))
    towns = df.where(F.col("department").isin("dept_00", "dept_01") & ~F.col("new_location"))
    pick = lambda rows, c: encoding.Encoder(encoding.fit_codes(rows.select(c)), None).categories()[c]
    return df.select(
        "event_id",
        encoding.label_code(df, "login_status", pick(status, "login_status")).alias("login_status"),
        encoding.label_code(df, "geo_location", pick(towns, "geo_location")).alias("geo_location"),
    )


@query(
    "g04_onehot",
    o.sql(
        "SELECT event_id, column_name, value, CASE WHEN value = actual THEN 1 ELSE 0 END AS dummy FROM ("
        + " UNION ALL ".join(
            f"SELECT event_id, '{c}' AS cn, "
            + (f"coalesce({c}, '{cfg.BROWSER_DEFAULT}')" if c == "browser" else c)
            + " AS actual FROM access_log"
            for c in cfg.ONEHOT_COLUMNS
        )
        + ") JOIN codes ON column_name = cn AND code > 0",
        CODES,
    ),
)
def g04(spark, sf):
    """Every dummy column, unpivoted."""
    df = encoding.prepare(log(spark, sf))
    cats = encoding.Encoder(encoding.fit_codes(df), None).categories()
    items = [
        F.struct(F.lit(c).alias("column_name"), F.lit(v).alias("value"), x.alias("dummy"))
        for c in cfg.ONEHOT_COLUMNS
        for v, x in zip(cats[c][1:], encoding.dummies(c, cats[c]).values())
    ]
    return df.select("event_id", F.explode(F.array(*items)).alias("i")).select("event_id", "i.*")


@query(
    "g04_onehot_sparse",
    o.sql(
        "SELECT event_id, concat(column_name, '_', value) AS feature FROM ("
        + " UNION ALL ".join(
            f"SELECT event_id, '{c}' AS cn, "
            + (f"coalesce({c}, '{cfg.BROWSER_DEFAULT}')" if c == "browser" else c)
            + " AS actual FROM access_log"
            for c in cfg.ONEHOT_COLUMNS
        )
        + ") JOIN codes ON column_name = cn AND value = actual AND code > 0",
        CODES,
    ),
)
def g04_sparse(spark, sf):
    df = log(spark, sf)
    return encoding.sparse_dummies(df, encoding.Encoder(encoding.fit_codes(encoding.prepare(df)), None))


_SCALED = ["login_hour", "bytes_uploaded", "bytes_downloaded", "failed_attempts", "geo_velocity_kmph"]
_SCALED_SQL = ", ".join(
    f"{o.rd(f'({c} - (SELECT avg({c}) FROM access_log)) / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM access_log)')} AS {c}"
    for c in _SCALED
)


@query("g05_scaled", o.sql(f"SELECT event_id, {_SCALED_SQL} FROM access_log"))
def g05(spark, sf):
    df = log(spark, sf)
    fit = {x["column_name"]: x for x in encoding.fit_scaler(df, _SCALED).collect()}
    return df.select("event_id", *[r(encoding.scaled(c, fit[c]["mean"], fit[c]["std"])).alias(c) for c in _SCALED])


_REPLAY = {
    "resource_sensitivity": f"CAST({_case('resource_sensitivity', cfg.ORDINAL_LEVELS['resource_sensitivity'])} AS DOUBLE)",
    "entity_type": "CAST((SELECT code FROM codes WHERE column_name = 'entity_type' AND value = entity_type) AS DOUBLE)",
    "session_duration_min": o.rd(
        "(greatest(session_duration_min, 0) - (SELECT avg(greatest(session_duration_min, 0)) FROM access_log)) / "
        "(SELECT stddev_pop(greatest(session_duration_min, 0)) FROM access_log)"
    ),
    "hour_sin": o.rd(
        "(hour_sin - (SELECT avg(hour_sin) FROM enriched)) / (SELECT stddev_pop(hour_sin) FROM enriched)"
    ),
    "consecutive_failures": o.rd(
        "(consecutive_failures - (SELECT avg(consecutive_failures) FROM enriched)) / "
        "(SELECT stddev_pop(consecutive_failures) FROM enriched)"
    ),
    "browser_Edge": "CASE WHEN browser = 'Edge' THEN CAST(1 AS DOUBLE) ELSE 0 END",
    "browser_Not_Applicable": "CASE WHEN browser IS NULL THEN CAST(1 AS DOUBLE) ELSE 0 END",
    "day_of_month": "CAST(day_of_month AS DOUBLE)",
}
_REPLAY_SQL = "SELECT event_id, " + ", ".join(f"{x} AS {n}" for n, x in _REPLAY.items()) + ", label, anomaly_type FROM {}"


@query("g06_replay_encoder", o.sql(_REPLAY_SQL.format("enriched") + f" WHERE {_LATE}", o.ENRICHED, CODES))
def g06(spark, sf):
    """Encoder fitted on all events and replayed on the later ones."""
    rows = profiled(spark, sf)
    encoder = shared(spark, sf, "encoder", lambda: encoding.fit_encoder(rows))
    matrix = encoding.apply_encoder(late(rows), encoder)
    return matrix.select("event_id", *[r(c) for c in _REPLAY], "label", "anomaly_type")


@query("g07_matrix", o.sql(_REPLAY_SQL.format("enriched"), o.ENRICHED, CODES))
def g07(spark, sf):
    rows = profiled(spark, sf)
    matrix = encoding.apply_encoder(rows, encoding.fit_encoder(rows))
    return matrix.select("event_id", *[r(c) for c in _REPLAY], "label", "anomaly_type")


_WIDE = "concat('b', CAST((event_id * 7) % 1709 AS VARCHAR))"
_WIDE_CODES = f"wide AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT {_WIDE} AS value FROM access_log))"


@query(
    "g07_matrix_wide",
    o.sql(
        f"SELECT e.event_id, CASE WHEN code > 0 THEN concat('browser_', value) END AS feature, "
        "CASE WHEN code > 0 THEN CAST(1 AS DOUBLE) END AS x, (SELECT count(*) - 1 FROM wide) AS dummies, "
        "CAST(day_of_month AS DOUBLE) AS day_of_month "
        f"FROM enriched e JOIN wide ON value = {_WIDE.replace('event_id', 'e.event_id')}",
        o.ENRICHED, _WIDE_CODES,
    ),
)
def g07_wide(spark, sf):
    """A column of up to 1,709 values: coded by a join, one (index, value) pair a row."""
    wide = F.concat(F.lit("b"), (F.col("event_id") * 7 % 1709).cast("string"))
    rows = profiled(spark, sf).withColumn("browser", wide)
    encoder = encoding.fit_encoder(rows)
    matrix = encoding.apply_sparse(rows, encoder)
    names = keep(encoding.feature_table(encoder, rows.columns), "feature-names")
    browsers = names.where(F.col("feature").startswith("browser_"))
    day = names.where(F.col("feature") == "day_of_month").select("index").scalar()
    cells = F.map_from_arrays("features.at", "features.x")
    mine = matrix.select("event_id", F.explode(F.map_entries(cells)).alias("c")).select(
        "event_id", F.col("c.key").alias("index"), F.col("c.value").alias("x")
    )
    mine = mine.join(browsers, "index").select("event_id", "feature", "x")
    days = matrix.select("event_id", F.coalesce(F.try_element_at(cells, day), F.lit(0.0)).alias("day_of_month"))
    return days.join(mine, "event_id", "left").withColumn("dummies", browsers.select(F.count(F.lit(1))).scalar())


@query(
    "g08_class_codes",
    o.sql(
        "SELECT event_id, anomaly_type, CAST((SELECT count(DISTINCT anomaly_type) FROM access_log b "
        "WHERE b.anomaly_type <> 'Normal' AND b.anomaly_type < a.anomaly_type) AS DOUBLE) AS class_code, "
        "anomaly_type AS decoded FROM access_log a WHERE anomaly_type <> 'Normal'"
    ),
)
def g08(spark, sf):
    rows = cl.training_rows(log(spark, sf))
    classes = cl.class_names(rows)
    coded = rows.withColumn("class_code", cl.encode_class("anomaly_type", classes))
    return coded.select("event_id", "anomaly_type", "class_code", cl.decode_class("class_code", classes).alias("decoded"))
