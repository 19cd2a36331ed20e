"""Registered queries: the analyst's questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators import risk as rk
from watchfold.plans import analyst as a
from watchfold.plans import oracle as o
from watchfold.plans.registry import (
    batch, enriched, fitted_profiles, log, query, r, rule_decision, rule_score, rule_scored,
)


def _scored(spark, sf):
    return rule_scored(log(spark, sf))


def _scored_sql(text: str, *more: str) -> str:
    return o.sql(text, o.SCORED, *more)


@query(
    "n01_scored_view",
    o.sql(
        "SELECT e.event_id, e.entity_login_count, e.consecutive_failures, s.risk_score, s.risk_level, s.risk_contributors, "
        "s.is_anomaly FROM enriched e JOIN scored s USING (event_id)",
        o.ENRICHED, o.SCORED,
    ),
)
def n01(spark, sf):
    rows = enriched(spark, sf)
    scores = rows.withColumn("anomaly_score", rule_score()).withColumn(
        "prediction", F.when(rule_decision() < 0, -1).otherwise(1)
    )
    view = a.scored_view(rows, rk.score_risk(scores, attack_col="anomaly_type"))
    return view.select(
        "event_id", "entity_login_count", "consecutive_failures", "risk_score", "risk_level", "risk_contributors", "is_anomaly"
    )


@query(
    "n02_search",
    _scored_sql(
        "SELECT event_id, entity_id, risk_score FROM scored WHERE contains(lower(entity_id), 'ent_00001') "
        "OR contains(CAST(event_id AS VARCHAR), 'ent_00001') UNION ALL "
        "SELECT event_id, entity_id, risk_score FROM scored WHERE regexp_matches(entity_id, '(?i)T_.*[27]3$') "
        "OR regexp_matches(CAST(event_id AS VARCHAR), '(?i)T_.*[27]3$')"
    ),
)
def n02(spark, sf):
    """Plain text, and a pattern."""
    rows = _scored(spark, sf)
    cols = ["event_id", "entity_id", "risk_score"]
    plain = a.matching(rows, search="ENT_00001").select(*cols)
    return plain.unionAll(a.matching(rows, search="T_.*[27]3$", regex=True).select(*cols))


@query(
    "n03_filters",
    _scored_sql(
        "SELECT event_id, risk_score FROM scored WHERE entity_type = 'User' AND department = 'dept_03' "
        "UNION ALL SELECT event_id, risk_score FROM scored WHERE anomaly_type = 'Brute Force'"
    ),
)
def n03(spark, sf):
    rows = _scored(spark, sf)
    one = a.matching(rows, entity_type="User", department="dept_03")
    return one.select("event_id", "risk_score").unionAll(
        a.matching(rows, attack="Brute Force").select("event_id", "risk_score")
    )


@query(
    "n04_filter_options",
    o.sql(
        "SELECT DISTINCT 'entity_type' AS filter, entity_type AS value FROM access_log UNION "
        "SELECT 'department', department FROM access_log UNION "
        "SELECT 'attack_type', anomaly_type FROM access_log WHERE label = 'Anomaly'"
    ),
)
def n04(spark, sf):
    return a.filter_options(log(spark, sf))


@query(
    "n05_kpis",
    _scored_sql(
        "SELECT count(*) AS events, CAST(sum(is_anomaly) AS BIGINT) AS anomalies, count(*) FILTER (WHERE risk_score >= 75) AS high_risk, "
        "count(DISTINCT anomaly_type) FILTER (WHERE label = 'Anomaly') AS attack_classes, count(DISTINCT entity_id) AS entities FROM scored"
    ),
)
def n05(spark, sf):
    return a.kpis(_scored(spark, sf))


@query(
    "n06_attack_distribution",
    o.sql("SELECT anomaly_type, count(*) AS n FROM access_log WHERE label = 'Anomaly' GROUP BY anomaly_type"),
)
def n06(spark, sf):
    return a.attack_distribution(log(spark, sf))


@query(
    "n07_risk_histogram",
    _scored_sql("SELECT CAST(least(50, floor(risk_score / 2) + 1) AS INT) AS bin, count(*) AS n FROM scored GROUP BY 1"),
)
def n07(spark, sf):
    return a.risk_histogram(_scored(spark, sf))


@query(
    "n08_anomalies_by_department",
    o.sql("SELECT department, count(*) AS n FROM access_log WHERE label = 'Anomaly' GROUP BY department"),
)
def n08(spark, sf):
    return a.anomalies_by_department(log(spark, sf))


@query(
    "n09_anomalies_by_hour",
    o.sql("SELECT login_hour, count(*) AS n FROM access_log WHERE label = 'Anomaly' GROUP BY login_hour"),
)
def n09(spark, sf):
    return a.anomalies_by_hour(log(spark, sf))


@query(
    "n11_triage",
    _scored_sql(
        f"SELECT {', '.join(o.rdas(c) if c == 'session_duration_min' else c for c in cfg.TRIAGE_COLUMNS)} FROM scored "
        "WHERE risk_score >= 50 ORDER BY risk_score DESC, event_id LIMIT 500"
    ),
)
def n11(spark, sf):
    return a.triage(_scored(spark, sf)).withColumn("session_duration_min", r("session_duration_min"))


_TOP = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, v AS value, n FROM (SELECT {c} AS v, count(*) AS n FROM scored "
    f"WHERE risk_score >= 50 GROUP BY {c} ORDER BY n DESC, v LIMIT 1)"
    for c in ("entity_id", "resource_accessed", "department")
)


@query("n12_top_threats", _scored_sql(_TOP))
def n12(spark, sf):
    return a.top_threats(_scored(spark, sf))


@query(
    "n13_triage_summary",
    _scored_sql(
        f"SELECT count(*) AS alerts, {o.rd('avg(risk_score)', 1)} AS avg_risk, count(DISTINCT entity_id) AS entities "
        "FROM scored WHERE risk_score >= 50"
    ),
)
def n13(spark, sf):
    return a.triage_summary(_scored(spark, sf))


@query(
    "n14_entity_cards",
    _scored_sql(
        "SELECT entity_id, arg_min(entity_type, event_ts) AS entity_type, arg_min(department, event_ts) AS department, "
        "count(*) AS events, CAST(sum(is_anomaly) AS BIGINT) AS anomalies FROM scored GROUP BY entity_id"
    ),
)
def n14(spark, sf):
    return a.entity_card(_scored(spark, sf))


@query(
    "n15_entity_timeline",
    _scored_sql(
        "SELECT event_id, entity_id, epoch_us(event_ts) AS ts_us, risk_score, is_anomaly, anomaly_type, resource_accessed "
        "FROM scored WHERE entity_id = 'ent_000005'"
    ),
)
def n15(spark, sf):
    rows = a.entity_timeline(_scored(spark, sf), "ent_000005")
    return rows.withColumn("ts_us", F.unix_micros(F.col("event_ts").cast("timestamp"))).drop("event_ts")


_METRICS = " UNION ALL ".join(
    f"SELECT entity_id, e.first_department AS department, '{label}' AS metric, e.{m} AS e, d.{m} AS d "
    "FROM ent e LEFT JOIN dept d ON d.department = e.first_department"
    for m, label in cfg.PROFILE_METRICS.items()
)
_COMPARED = (
    o.profile_cte("ent", "entity_id", "access_log"),
    o.profile_cte("dept", "department", "access_log"),
    f"compared AS ({_METRICS})",
)


def _comparison(spark, sf):
    return a.entity_vs_department(fitted_profiles(spark, sf), a.entity_card(_scored(spark, sf)))


@query(
    "n16_entity_vs_department",
    o.sql(
        f"SELECT entity_id, department, metric, {o.half_up('e', 2)} AS entity_value, {o.half_up('d', 2)} AS department_value, "
        f"{o.half_up('CASE WHEN d <> 0 THEN (e - d) / d * 100 ELSE 0 END', 1)} AS deviation_pct FROM compared",
        *_COMPARED,
    ),
)
def n16(spark, sf):
    return _comparison(spark, sf).drop("entity_radar", "department_radar")


@query(
    "n17_radar",
    o.sql(
        f"SELECT entity_id, metric, {o.rd('e / greatest(abs(e), abs(d), 1)')} AS entity_radar, "
        f"{o.rd('d / greatest(abs(e), abs(d), 1)')} AS department_radar FROM compared",
        *_COMPARED,
    ),
)
def n17(spark, sf):
    return _comparison(spark, sf).select("entity_id", "metric", r("entity_radar"), r("department_radar"))


@query(
    "n18_alert_labels",
    _scored_sql(
        "SELECT event_id, concat(event_id, ' | ', entity_id, ' | Risk: ', CAST(risk_score AS VARCHAR), ' (', risk_level, ')') AS label "
        "FROM scored WHERE is_anomaly = 1 ORDER BY risk_score DESC, event_id LIMIT 100"
    ),
)
def n18(spark, sf):
    return a.alert_labels(_scored(spark, sf))


_DETAIL = " UNION ALL ".join(
    f"SELECT event_id, {i} AS position, '{c}' AS field, "
    + (f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c == "event_ts" else f"CAST({c} AS VARCHAR)")
    + " AS value FROM access_log"
    for i, c in enumerate(cfg.DETAIL_COLUMNS, 1)
)


@query("n19_alert_detail", o.sql(_DETAIL))
def n19(spark, sf):
    """Field by field, for every event; timestamps to the second."""
    rows = a.alert_detail(log(spark, sf))
    short = F.when(F.col("field") == "event_ts", F.substring("value", 1, 19)).otherwise(F.col("value"))
    return rows.withColumn("value", short)


@query(
    "n20_alert_actions",
    _scored_sql(
        "SELECT event_id, CAST(generate_subscripts(string_split(actions, '; '), 1) AS INT) AS step, unnest(string_split(actions, '; ')) AS action "
        "FROM acted WHERE actions <> ''",
        o.ACTIONS,
    ),
)
def n20(spark, sf):
    return a.alert_actions(_scored(spark, sf))


@query("n22_entity_list", o.sql("SELECT DISTINCT entity_id FROM access_log"))
def n22(spark, sf):
    return a.entity_list(log(spark, sf))


@query(
    "n23_scored_triage",
    o.sql("SELECT true AS some, true AS high_first, CAST(0 AS BIGINT) AS not_alerts, CAST(0 AS BIGINT) AS repeated FROM (SELECT count(*) FROM access_log)"),
)
def n23(spark, sf):
    """Triage over the events as scored by the real models: alerts only, each once."""
    out = a.triage(batch(spark, sf).scored)
    known = batch(spark, sf).scored.select("event_id", F.col("risk_score").alias("score"))
    rest = known.join(out, "event_id", "left_anti").agg(F.coalesce(F.max("score"), F.lit(0.0))).scalar()
    n = F.count(F.lit(1))
    return out.join(known, "event_id").agg(
        (n > 0).alias("some"),
        (F.min("score") >= rest).alias("high_first"),
        F.count_if(F.col("score") < cfg.TRIAGE_MIN_RISK).alias("not_alerts"),
        (n - F.count_distinct("event_id")).alias("repeated"),
    )
