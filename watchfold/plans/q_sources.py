"""Registered queries: scans, sinks, stored state."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators import classify as cl
from watchfold.operators import drift, encoding, explain, forest, profiles, quality
from watchfold.plans import analyst, oracle as o
from watchfold.plans.q_quality import REPORT, all_findings
from watchfold.plans.registry import batch, enriched, log, prepared, profiled, query, r, rule_scored
from watchfold.session import fresh_path
from watchfold.sources import tables
from watchfold.sources.access_log import access_schema, read_access_log
from watchfold.streaming import live

_ALL = [f.name for f in access_schema().fields if f.name != "event_ts"]
_ALL_SQL = ", ".join(o.rdas(c) if c in ("geo_velocity_kmph", "session_duration_min") else c for c in _ALL)


def _plain(df):
    return df.select(
        *[r(c) if c in ("geo_velocity_kmph", "session_duration_min") else F.col(c) for c in _ALL]
    )


@query("a01_scan", o.sql(f"SELECT {_ALL_SQL} FROM access_log"))
def a01(spark, sf):
    """Raw table written and scanned with a declared schema."""
    path = tables.write_table(read_access_log(spark, sf), fresh_path(spark, "raw"))
    return _plain(tables.read_events(spark, path))


@query("a02_csv_scan", o.sql(f"SELECT {_ALL_SQL} FROM access_log"))
def a02(spark, sf):
    path = tables.write_table(log(spark, sf), fresh_path(spark, "raw-csv"), "csv")
    return _plain(tables.read_events(spark, path, "csv"))


@query(
    "a03_live_records",
    o.sql("SELECT entity_id, count(*) AS events, count(*) AS ids FROM access_log GROUP BY entity_id"),
)
def a03(spark, sf):
    """JSON records without an id get one each."""
    path = fresh_path(spark, "raw-json")
    log(spark, sf).drop("event_id").write.json(path)
    rows = tables.with_event_id(spark.read.schema(access_schema()).json(path).drop("event_id"))
    return rows.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids")
    )


@query(
    "a04_enriched_by_day",
    o.sql(
        "SELECT strftime(event_ts, '%Y-%m-%d') AS event_date, count(*) AS events, "
        f"{o.rd('sum(time_since_last_login_min)', 3)} AS total_gap, "
        "CAST(sum(consecutive_failures) AS BIGINT) AS failures FROM enriched GROUP BY 1",
        o.ENRICHED,
    ),
)
def a04(spark, sf):
    path = tables.write_events_by_day(enriched(spark, sf), fresh_path(spark, "enriched-days"))
    back = spark.read.parquet(path)
    return back.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("event_date")).agg(
        F.count(F.lit(1)).alias("events"),
        r(F.sum("time_since_last_login_min"), 3).alias("total_gap"),
        F.sum("consecutive_failures").alias("failures"),
    )


_LEVELS = "CASE resource_sensitivity WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 WHEN 'Critical' THEN 3 ELSE -1 END"


@query(
    "a05_matrix_round_trip",
    o.sql(
        f"SELECT label, anomaly_type, count(*) AS events, {o.rd(f'sum({_LEVELS})')} AS sensitivity "
        "FROM access_log GROUP BY label, anomaly_type"
    ),
)
def a05(spark, sf):
    """The processed table, written as CSV and split into targets and features."""
    p = prepared(spark, sf)
    matrix = encoding.apply_encoder(p.profiled, p.encoder)
    path = tables.write_table(matrix, fresh_path(spark, "processed"), "csv")
    targets, features = tables.split_matrix(tables.read_table(spark, path, matrix.schema, "csv"))
    return (
        targets.join(features, "event_id")
        .groupBy("label", "anomaly_type")
        .agg(F.count(F.lit(1)).alias("events"), r(F.sum("resource_sensitivity")).alias("sensitivity"))
    )


@query(
    "a06_profile_store",
    o.sql(f"SELECT department, {o.profile_columns()} FROM dept", o.profile_cte("dept", "department", "access_log")),
)
def a06(spark, sf):
    path = fresh_path(spark, "profile-store")
    profiles.fit_profiles(log(spark, sf)).save(path)
    dept = profiles.Profiles.load(spark, path).department
    return dept.select(
        "department", *[F.col(c) if d is None else r(c, d) for c, d in o.PROFILE_COLUMNS.items()]
    )


_CODED = cfg.LABEL_COLUMNS + cfg.ONEHOT_COLUMNS


def _coded_text(c: str) -> str:
    if c in ("is_off_hours", "new_device", "new_location"):
        return f"CASE WHEN {c} THEN 'True' ELSE 'False' END"
    return f"coalesce({c}, '{cfg.BROWSER_DEFAULT}')" if c == "browser" else c


CODES = "codes AS (SELECT column_name, value, CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INT) AS code FROM (" + (
    " UNION ".join(f"SELECT '{c}' AS column_name, {_coded_text(c)} AS value FROM access_log" for c in _CODED)
) + "))"


@query("a07_encoder_store", o.sql("SELECT column_name, value, code FROM codes", CODES))
def a07(spark, sf):
    path = fresh_path(spark, "encoder-store")
    encoding.fit_encoder(profiled(spark, sf)).save(path)
    return encoding.Encoder.load(spark, path).codes


_SAME = o.sql("SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM access_log")


def _differing(before, after):
    """Rows of two results for the same events, and how many of them are not equal."""
    apart = before.exceptAll(after).count() + after.exceptAll(before).count()
    return after.agg(F.count(F.lit(1)).alias("n")).withColumn("differing", F.lit(apart).cast("long"))


@query("a08_model_store", _SAME)
def a08(spark, sf):
    """Forest and classifier saved and loaded: the loaded pair scores every event as before."""
    b, path = batch(spark, sf), fresh_path(spark, "model-store")
    b.fitted.forest.save(f"{path}/forest")
    b.fitted.classifier.save(f"{path}/classifier")
    vectors = b.matrix

    def scored(trees, model):
        out = cl.classify_flagged(forest.score_forest(vectors, trees), model)
        return out.select("event_id", "prediction", r("anomaly_score"), "attack")

    loaded = forest.Forest.load(spark, f"{path}/forest"), cl.Classifier.load(spark, f"{path}/classifier")
    return _differing(scored(b.fitted.forest, b.fitted.classifier), scored(*loaded))


@query("a09_importance_store", "SELECT CAST(15 AS BIGINT) AS n, CAST(0 AS BIGINT) AS differing")
def a09(spark, sf):
    """The summary of importances written and read back."""
    b = batch(spark, sf)
    vectors = b.matrix
    table = explain.global_summary(b.fitted.classifier, vectors)
    path = tables.write_table(table, fresh_path(spark, "importances"))
    return _differing(table, tables.read_table(spark, path, table.schema))


@query(
    "a10_drift_store",
    o.sql(
        f"SELECT 'session_duration_min' AS feature, {o.rd('session_duration_min', 4)} AS value, count(*) AS n "
        "FROM access_log GROUP BY 2 UNION ALL "
        f"SELECT 'hour_sin', {o.rd('sin(2 * pi() * login_hour / 24)', 4)}, count(*) FROM access_log GROUP BY 2"
    ),
)
def a10(spark, sf):
    rows = enriched(spark, sf).select("session_duration_min", "hour_sin")
    path = tables.write_table(drift.fit_reference(rows), fresh_path(spark, "drift-store"))
    return tables.read_table(spark, path, "feature string, value double, n long").select("feature", "value", "n")


_EXPORT = ["event_id", "entity_id", "department", "risk_score", "risk_level", "risk_contributors"]


@query(
    "a11_alert_export",
    o.sql(f"SELECT {', '.join(_EXPORT)} FROM scored WHERE risk_score >= 50", o.SCORED),
)
def a11(spark, sf):
    alerts = analyst.alerts(rule_scored(log(spark, sf))).select(*_EXPORT)
    path = tables.write_table(alerts, fresh_path(spark, "alerts"), "csv")
    return tables.read_table(spark, path, alerts.schema, "csv")


@query("a12_report_lines", REPORT)
def a12(spark, sf):
    """The report written as text and read back."""
    path = tables.write_report_lines(quality.report_lines(all_findings(spark, sf)), fresh_path(spark, "report"))
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("a13_fitted_store", _SAME)
def a13(spark, sf):
    """The complete scorer saved and loaded: it answers every event as before."""
    path = fresh_path(spark, "fitted")
    b = batch(spark, sf)
    b.fitted.save(path)

    def said(fitted):
        out = live.respond_to(log(spark, sf), fitted)
        return out.select("event_id", "is_anomaly", "attack_classification", r("risk_score"), "risk_level", "explanation")

    return _differing(said(b.fitted), said(type(b.fitted).load(spark, path)))
