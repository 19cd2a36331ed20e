"""Registered queries: risk rules, responses, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators import drift, respond, risk
from watchfold.plans import oracle as o
from watchfold.plans.registry import (
    deviations, log, query, r, rule_score, rule_scored, shared,
)
from watchfold.session import keep


def _scorable(spark, sf):
    return log(spark, sf).withColumn("anomaly_score", rule_score())


# --- risk ----------------------------------------------------------------------

_RULES = {
    "j01_anomaly_confidence": "anomaly",
    "j02_resource_sensitivity": "resource",
    "j03_privilege": "privilege",
    "j04_off_hours": "off_hours",
    "j05_new_device": "new_device",
    "j06_new_location": "new_location",
    "j07_failed_attempts": "failures",
    "j08_geo_velocity": "travel",
    "j09_attack_bump": "attack",
}


def _rule_query(name: str, rule: str) -> None:
    points, text = o.RISK_TERMS[rule]

    @query(
        name,
        o.sql(
            f"SELECT event_id, {o.rd(points)} AS points, {text} AS contributor "
            f"FROM (SELECT *, {o.RULE_SCORE} AS s FROM access_log)"
        ),
    )
    def run(spark, sf):
        df = _scorable(spark, sf)
        pts, said = risk.risk_terms(df.columns, attack_col="anomaly_type")[rule]
        return df.select("event_id", r(pts).alias("points"), said.alias("contributor"))


for _name, _rule in _RULES.items():
    _rule_query(_name, _rule)


@query("j10_risk_score", o.sql(f"SELECT event_id, {o.rd('raw_risk')} AS risk_score FROM scored", o.SCORED))
def j10(spark, sf):
    return risk.score_risk(_scorable(spark, sf), attack_col="anomaly_type").select("event_id", r("risk_score"))


@query("j11_risk_level", o.sql("SELECT event_id, risk_level FROM scored", o.SCORED))
def j11(spark, sf):
    return risk.score_risk(_scorable(spark, sf), attack_col="anomaly_type").select("event_id", "risk_level")


@query("j12_risk_contributors", o.sql("SELECT event_id, risk_contributors FROM scored", o.SCORED))
def j12(spark, sf):
    return risk.score_risk(_scorable(spark, sf), attack_col="anomaly_type").select("event_id", "risk_contributors")


@query("j13_level_histogram", o.sql("SELECT risk_level, count(*) AS n FROM scored GROUP BY risk_level", o.SCORED))
def j13(spark, sf):
    return risk.level_histogram(risk.score_risk(_scorable(spark, sf), attack_col="anomaly_type"))


# --- responses -----------------------------------------------------------------


@query("k01_recommended_actions", o.sql("SELECT event_id, actions FROM acted", o.SCORED, o.ACTIONS))
def k01(spark, sf):
    acted = respond.recommend(rule_scored(log(spark, sf)))
    return acted.select("event_id", F.array_join("actions", "; ").alias("actions"))


@query(
    "k02_playbook_use",
    o.sql(
        "SELECT t AS anomaly_type, lv AS risk_level, acts AS actions, count(event_id) AS events FROM playbook "
        "LEFT JOIN scored ON anomaly_type = t AND risk_level = lv GROUP BY ALL",
        o.SCORED, o.PLAYBOOKS,
    ),
)
def k02(spark, sf):
    """Every playbook entry with the number of events it answers."""
    seen = rule_scored(log(spark, sf)).groupBy("anomaly_type", "risk_level").agg(F.count(F.lit(1)).alias("events"))
    book = respond.playbook_table(spark).withColumn("actions", F.array_join("actions", "; "))
    return book.join(seen, ["anomaly_type", "risk_level"], "left").fillna(0, subset=["events"])


@query(
    "k03_action_counts",
    o.sql(
        "SELECT action, count(*) AS n FROM (SELECT unnest(string_split(actions, '; ')) AS action FROM acted) GROUP BY action",
        o.SCORED, o.ACTIONS,
    ),
)
def k03(spark, sf):
    return respond.action_counts(respond.recommend(rule_scored(log(spark, sf))))


# --- drift ---------------------------------------------------------------------

_HOUR_DEV = "abs(e.login_hour - p.m) / coalesce(nullif(p.sd, 0), 1)"
_TRACKED = cfg.DRIFT_FEATURES
_INPUT = f"""{o.ENRICHED},{o.SCORED},
hours AS (SELECT entity_id, avg(login_hour) AS m, stddev_pop(login_hour) AS sd FROM access_log GROUP BY entity_id),
tracked AS (
  SELECT e.event_id, e.entity_id, e.event_ts, e.resource_access_entropy, e.session_duration_min, e.bytes_uploaded_zscore,
    e.consecutive_failures, e.hour_sin, {_HOUR_DEV} AS profile_hour_deviation, s.risk_score
  FROM enriched e JOIN scored s USING (event_id) JOIN hours p ON p.entity_id = e.entity_id)"""
_BY_TIME = "event_ts < make_timestamp(CAST(floor((SELECT quantile_cont(CAST(epoch_us(event_ts) AS DOUBLE), 0.7) FROM access_log)) AS BIGINT) + 1)"


def _tracked(spark, sf):
    def make():
        rows = deviations(spark, sf)
        # A score depends on its own row only: nothing is joined, by broadcast or by shuffle.
        return keep(rule_scored(rows).select("event_id", "entity_id", "event_ts", *_TRACKED), "tracked")

    return shared(spark, sf, "tracked", make)


def _ks_sql(is_reference: str, features=_TRACKED) -> str:
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS raw, {o.rd(f, 4)} AS v, {is_reference} AS ref FROM tracked"
        for f in features
    )
    return f"""{_INPUT},
longform AS ({long}),
sizes AS (
  SELECT feature, CAST(count(*) FILTER (WHERE ref) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE NOT ref) AS DOUBLE) AS m,
    avg(raw) FILTER (WHERE ref) AS reference_mean, avg(v) FILTER (WHERE NOT ref) AS current_mean
  FROM longform GROUP BY feature),
steps AS (SELECT feature, v, count(*) FILTER (WHERE ref) AS a, count(*) FILTER (WHERE NOT ref) AS b FROM longform GROUP BY feature, v),
upto AS (SELECT feature, sum(a) OVER (PARTITION BY feature ORDER BY v) AS ca, sum(b) OVER (PARTITION BY feature ORDER BY v) AS cb FROM steps),
stat AS (SELECT feature, max(abs(ca / n - cb / m)) AS ks_statistic FROM upto JOIN sizes USING (feature) GROUP BY feature),
tested AS (
  SELECT feature, ks_statistic, reference_mean, current_mean, ks_statistic * ks_statistic * (n * m / (n + m)) AS lam2
  FROM stat JOIN sizes USING (feature)),
drifted AS (
  SELECT *, CASE WHEN lam2 < 0.04 THEN 1 ELSE least(1, greatest(0, list_sum(list_transform(range(1, 101),
    lambda j: (CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END) * exp(CAST(-2 AS DOUBLE) * j * j * lam2))))) END AS p_value
  FROM tested)"""


def _by_time(spark, sf):
    return drift.split_by_time(_tracked(spark, sf))


@query(
    "m01_reference_distribution",
    o.sql("SELECT feature, v AS value, a AS n FROM steps WHERE a > 0", _ks_sql(_BY_TIME)),
)
def m01(spark, sf):
    reference, _ = _by_time(spark, sf)
    return drift.fit_reference(reference).select("feature", "value", "n")


@query("m02_split_by_time", o.sql(f"SELECT event_id, {_BY_TIME} AS is_reference FROM access_log"))
def m02(spark, sf):
    first, rest = drift.split_by_time(log(spark, sf))
    mark = lambda t, b: t.select("event_id", F.lit(b).alias("is_reference"))
    return mark(first, True).unionAll(mark(rest, False))


_ENTITY_ORDER = (
    "SELECT event_id, row_number() OVER (ORDER BY entity_id, event_ts, event_id) "
    "<= floor(0.7 * (SELECT count(*) FROM access_log)) AS is_reference FROM access_log"
)


@query("m02_split_by_entity_order", o.sql(_ENTITY_ORDER))
def m02_entity(spark, sf):
    return drift.split_by_entity_order(log(spark, sf)).select("event_id", "is_reference")


@query("m03_ks_statistic", o.sql(f"SELECT feature, {o.rdas('ks_statistic')} FROM stat", _ks_sql(_BY_TIME)))
def m03(spark, sf):
    reference, current = _by_time(spark, sf)
    return drift.detect_drift(drift.fit_reference(reference), current).select("feature", r("ks_statistic"))


@query("m03_ks_statistic_split", o.sql(f"SELECT feature, {o.rdas('ks_statistic')} FROM stat", _ks_sql(_BY_TIME)))
def m03_split(spark, sf):
    """Every feature's distinct values cut into slices, as when there are very many."""
    reference, current = _by_time(spark, sf)
    out = drift.detect_drift(drift.fit_reference(reference), current, rows_per_slice=400)
    return out.select("feature", r("ks_statistic"))


@query("m04_ks_p_value", o.sql(f"SELECT feature, {o.rdas('p_value')} FROM drifted", _ks_sql(_BY_TIME)))
def m04(spark, sf):
    reference, current = _by_time(spark, sf)
    out = drift.detect_drift(drift.fit_reference(reference), current, exact_rows=0)
    return out.select("feature", r("p_value"))


# Equal sizes: the share of paths that leave the band is an alternating sum of binomials.
_EXACT = (
    "CASE WHEN n_ref > 10000 THEN p_value ELSE (SELECT 2 * sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(2 * lgamma(n_ref + 1.0) "
    "- lgamma(n_ref - k * h + 1.0) - lgamma(n_ref + k * h + 1.0))) FROM (SELECT unnest(range(1, 10001)) AS k) WHERE k * h <= n_ref) END"
)


@query(
    "m04_exact_p_value",
    o.sql(
        f"SELECT feature, {o.rd(f'least(1, greatest(0, {_EXACT}))')} AS p_value FROM (SELECT *, CAST(round(ks_statistic * n_ref) AS BIGINT) AS h FROM "
        "(SELECT d.*, (SELECT CAST(count(*) AS DOUBLE) FROM access_log WHERE event_id % 2 = 0) AS n_ref FROM drifted d))",
        _ks_sql("event_id % 2 = 0"),
    ),
)
def m04_exact(spark, sf):
    """Even against odd events: two samples of one size, small enough for the exact distribution up to 10,000 rows."""
    rows = _tracked(spark, sf)
    even, odd = rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")
    return drift.detect_drift(drift.fit_reference(even), odd).select("feature", r("p_value"))


@query(
    "m01_merged_sketches",
    o.sql("SELECT feature, true AS within_bound, (SELECT count(*) FROM access_log WHERE " + _BY_TIME + ") AS n FROM stat", _ks_sql(_BY_TIME)),
)
def m01_sketches(spark, sf):
    """Baselines of single days merged without their rows: as far from the rest as the exact distance says."""
    reference, current = _by_time(spark, sf)
    days = keep(drift.fit_sketch(reference.withColumn("day", F.dayofmonth("event_ts")), by=["day"]), "days")
    merged = drift.merge_sketches(days)
    rough = drift.sketched_drift(merged, drift.fit_sketch(current)).select("feature", F.col("ks_statistic").alias("rough"))
    exact = drift.detect_drift(drift.fit_reference(reference), current).select("feature", "ks_statistic")
    close = F.abs(F.col("rough") - F.col("ks_statistic")) <= 2 * drift.SKETCH_ERROR
    sizes = merged.select("feature", "n")
    return exact.join(rough, "feature").join(sizes, "feature").select("feature", close.alias("within_bound"), "n")


_BY_ENTITY = (
    "event_id IN (SELECT event_id FROM (" + _ENTITY_ORDER + ") WHERE is_reference)"
)


@query(
    "m05_drift_flags",
    o.sql(
        f"SELECT feature, p_value < 0.05 AS is_drifting, {o.rdas('reference_mean')}, {o.rdas('current_mean')} FROM drifted",
        _ks_sql(_BY_ENTITY),
    ),
)
def m05(spark, sf):
    """Reference = first 70 % of the rows in entity order."""
    marked = drift.split_by_entity_order(_tracked(spark, sf))
    out = drift.detect_drift(drift.fit_reference(marked.where("is_reference")), marked.where("NOT is_reference"))
    return out.select("feature", "is_drifting", r("reference_mean"), r("current_mean"))


_REPORTED = ", ".join(
    f"printf('%.4f', {c}) AS {c}" for c in ("reference_mean", "current_mean", "ks_statistic")
)


@query(
    "m06_drift_report",
    o.sql(
        f"SELECT feature, {_REPORTED}, printf('%.4e', p_value) AS p_value, "
        "CASE WHEN p_value < 0.05 THEN 'Yes' ELSE 'No' END AS drifting, "
        "(SELECT count(*) FROM drifted) AS features_tracked, "
        "(SELECT count(*) FROM drifted WHERE p_value < 0.05) AS features_drifting FROM drifted",
        _ks_sql(_BY_TIME),
    ),
)
def m06(spark, sf):
    reference, current = _by_time(spark, sf)
    out = keep(drift.detect_drift(drift.fit_reference(reference), current, exact_rows=0), "drift")
    whole = F.broadcast(drift.drift_summary(out).withColumn("_all", F.lit(0)))  # one row
    return drift.drift_report(out).withColumn("_all", F.lit(0)).join(whole, "_all").drop("_all")
