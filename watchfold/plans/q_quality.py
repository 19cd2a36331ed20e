"""Registered queries: data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators import quality as q
from watchfold.plans import oracle as o
from watchfold.plans.registry import log, query, r
from watchfold.sources.access_log import access_schema

_TYPES = {f.name: f.dataType.simpleString() for f in access_schema().fields}
_AS_OF = "2024-01-25 00:00:00"


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


@query(
    "b01_schema",
    o.sql(
        _union(
            f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null FROM access_log"
            for c, t in _TYPES.items()
        )
    ),
)
def b01(spark, sf):
    return q.column_types(log(spark, sf))


_MISSING = _union(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS total FROM access_log"
    for c in _TYPES
)


@query(
    "b02_missing_values",
    o.sql(
        f"SELECT column_name, missing, {o.rd('missing * 100.0 / total')} AS missing_pct, "
        "CASE WHEN missing * 100.0 / total >= 50 THEN 'ERROR' WHEN missing * 100.0 / total >= 5 THEN 'WARNING' "
        f"ELSE 'INFO' END AS severity FROM ({_MISSING}) WHERE missing > 0"
    ),
)
def b02(spark, sf):
    return q.missing_values(log(spark, sf)).select("column_name", "missing", r("missing_pct"), "severity")


_DUP = "entity_id, login_hour, day_of_week, resource_accessed, login_status"


@query(
    "b03_duplicates",
    o.sql(
        "SELECT 'all' AS over, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates, "
        "CASE WHEN coalesce(sum(n - 1), 0) = 0 THEN 'PASS' ELSE 'ERROR' END AS severity "
        f"FROM (SELECT count(*) AS n FROM access_log GROUP BY {', '.join(_TYPES)}) UNION ALL "
        "SELECT 'behaviour', CAST(coalesce(sum(n - 1), 0) AS BIGINT), "
        "CASE WHEN coalesce(sum(n - 1), 0) = 0 THEN 'PASS' ELSE 'ERROR' END "
        f"FROM (SELECT count(*) AS n FROM access_log GROUP BY {_DUP})"
    ),
)
def b03(spark, sf):
    df = log(spark, sf)
    over = lambda name, t: t.select(F.lit(name).alias("over"), "duplicates", "severity")
    return over("all", q.duplicate_rows(df)).unionAll(
        over("behaviour", q.duplicate_rows(df, _DUP.split(", ")))
    )


@query(
    "b04_unparseable_timestamps",
    o.sql(
        "SELECT count(*) FILTER (WHERE try_strptime(t, '%Y-%m-%d %H:%M:%S') IS NULL) AS unparseable, "
        "count(*) AS present FROM (SELECT CASE WHEN login_status = 'Failed' THEN concat('failed at ', login_hour) "
        "ELSE strftime(event_ts, '%Y-%m-%d %H:%M:%S') END AS t FROM access_log)"
    ),
)
def b04(spark, sf):
    """Timestamps as text, where failed logins carry a remark instead."""
    text = F.when(F.col("login_status") == "Failed", F.concat(F.lit("failed at "), "login_hour")).otherwise(
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss")
    )
    return q.unparseable(log(spark, sf).select(text.alias("t")), "t", "yyyy-MM-dd HH:mm:ss")


@query(
    "b05_time_span",
    o.sql(
        "SELECT strftime(min(event_ts), '%Y-%m-%d %H:%M:%S') AS first_ts, "
        "strftime(max(event_ts), '%Y-%m-%d %H:%M:%S') AS last_ts, "
        "CAST(floor((epoch_us(max(event_ts)) - epoch_us(min(event_ts))) / 86400000000) AS BIGINT) AS days FROM access_log"
    ),
)
def b05(spark, sf):
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return q.time_span(log(spark, sf)).select(fmt("first_ts"), fmt("last_ts"), "days")


@query(
    "b06_future_events",
    o.sql(f"SELECT count(*) FILTER (WHERE event_ts > TIMESTAMP '{_AS_OF}') AS future_events FROM access_log"),
)
def b06(spark, sf):
    return q.future_events(log(spark, sf), F.lit(_AS_OF).cast("timestamp_ntz"))


_DOMAINS = {
    **cfg.EXPECTED_VALUES,
    "anomaly_type": ["Normal", "Brute Force", "Insider Drift"],
    "privilege_level": ["User", "Admin"],
}


@query(
    "b07_unexpected_values",
    o.sql(
        _union(
            f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM access_log "
            f"WHERE {c} IS NOT NULL AND {c} NOT IN ({o.quoted(v)})"
            for c, v in _DOMAINS.items()
        )
    ),
)
def b07(spark, sf):
    return q.unexpected_values(log(spark, sf), _DOMAINS)


_SEEN = _union(
    f"SELECT '{c}' AS column_name, {c} AS value, min(event_id) AS f FROM access_log WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in cfg.CATEGORICAL_COLUMNS
)


@query(
    "b08_cardinality",
    o.sql(
        "SELECT column_name, count(*) AS distinct_values, "
        "string_agg(value, ', ' ORDER BY rk) FILTER (WHERE rk <= 8) AS sample_values FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY f, value) AS rk FROM ({_SEEN})) "
        "GROUP BY column_name"
    ),
)
def b08(spark, sf):
    return q.cardinality(log(spark, sf))


@query(
    "b09_negatives",
    o.sql(
        _union(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < 0) AS negatives, "
            f"{o.rd(f'min(CASE WHEN {c} < 0 THEN {c} END)')} AS lowest FROM access_log"
            for c in cfg.NON_NEGATIVE_COLUMNS
        )
    ),
)
def b09(spark, sf):
    return q.negatives(log(spark, sf)).select("column_name", "negatives", r("lowest"))


_NUMERIC = ["login_hour", "geo_velocity_kmph", "session_duration_min", "bytes_uploaded", "bytes_downloaded",
            "failed_attempts"]
_FIVE = "five AS (" + _union(
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS lowest, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3, CAST(max({c}) AS DOUBLE) AS highest FROM access_log"
    for c in _NUMERIC
) + ")"
_FIVE_OUT = ["lowest", "q1", "median", "q3", "highest"]
_FIVE_SQL = o.sql(f"SELECT column_name, {', '.join(o.rdas(c) for c in _FIVE_OUT)} FROM five", _FIVE)


@query("b10_five_numbers", _FIVE_SQL)
def b10(spark, sf):
    return q.five_numbers(log(spark, sf)).select("column_name", *[r(c) for c in _FIVE_OUT])


@query("b10_five_numbers_split", _FIVE_SQL)
def b10_split(spark, sf):
    """The same through ranked value counts, as for columns too large for one buffer."""
    return q.five_numbers(log(spark, sf), rows_per_slice=500).select("column_name", *[r(c) for c in _FIVE_OUT])


@query(
    "b11_iqr_outliers",
    o.sql(
        _union(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) "
            f"OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers FROM access_log, five WHERE column_name = '{c}'"
            for c in _NUMERIC
        ),
        _FIVE,
    ),
)
def b11(spark, sf):
    return q.iqr_outliers(log(spark, sf))


def _mismatch(label: str) -> str:
    a = f"count(*) FILTER (WHERE {label} = 'Normal' AND anomaly_type <> 'Normal')"
    b = f"count(*) FILTER (WHERE {label} = 'Anomaly' AND anomaly_type = 'Normal')"
    return (
        f"{a} AS normal_with_attack, {b} AS anomaly_without_attack, "
        f"CASE WHEN {a} + {b} > 0 THEN 'ERROR' ELSE 'PASS' END AS severity"
    )


_GUESS = "(CASE WHEN failed_attempts >= 3 OR new_device THEN 'Anomaly' ELSE 'Normal' END)"


@query(
    "b12_label_consistency",
    o.sql(
        f"SELECT 'recorded' AS source, {_mismatch('label')} FROM access_log UNION ALL "
        f"SELECT 'guessed', {_mismatch(_GUESS)} FROM access_log"
    ),
)
def b12(spark, sf):
    """The recorded labels, and labels guessed by a rule."""
    df = log(spark, sf)
    guess = F.when((F.col("failed_attempts") >= 3) | F.col("new_device"), "Anomaly").otherwise("Normal")
    named = lambda n, t: t.select(F.lit(n).alias("source"), "*")
    return named("recorded", q.label_mismatches(df)).unionAll(
        named("guessed", q.label_mismatches(df.withColumn("label", guess)))
    )


@query(
    "b13_class_distributions",
    o.sql(
        f"SELECT 'label' AS column_name, label AS value, count(*) AS n, "
        f"{o.rd('count(*) * 100.0 / (SELECT count(*) FROM access_log)')} AS pct FROM access_log GROUP BY label "
        "UNION ALL SELECT 'anomaly_type', anomaly_type, count(*), "
        f"{o.rd('count(*) * 100.0 / (SELECT count(*) FROM access_log)')} FROM access_log GROUP BY anomaly_type"
    ),
)
def b13(spark, sf):
    return q.class_distributions(log(spark, sf)).select("column_name", "value", "n", r("pct"))


@query(
    "b14_entity_coverage",
    o.sql(
        "SELECT coalesce(entity_type, '(all)') AS entity_type, count(DISTINCT entity_id) AS entities, "
        f"count(*) AS events, {o.rd('count(*) / CAST(count(DISTINCT entity_id) AS DOUBLE)')} AS events_per_entity "
        "FROM access_log GROUP BY ROLLUP (entity_type)"
    ),
)
def b14(spark, sf):
    return q.entity_coverage(log(spark, sf)).select("entity_type", "entities", "events", r("events_per_entity"))


def _found(position: int, section: str, severity: str, subject: str, metric: str, value: str, detail: str, rest: str) -> str:
    return (
        f"SELECT {position} AS position, '{section}' AS section, CAST({severity} AS VARCHAR) AS severity, {subject} AS subject, "
        f"{metric} AS metric, CAST({value} AS DOUBLE) AS value, CAST({detail} AS VARCHAR) AS detail {rest}"
    )


def _unless(n: str, level: str = "WARNING") -> str:
    return f"CASE WHEN {n} > 0 THEN '{level}' ELSE 'PASS' END"


_LOG = "FROM access_log"
_GRADE = "CASE WHEN missing * 100.0 / total >= 50 THEN 'ERROR' WHEN missing * 100.0 / total >= 5 THEN 'WARNING' ELSE 'INFO' END"
_PRESENT = f"(SELECT * FROM ({_MISSING}) WHERE missing > 0)"
_MISMATCHED = "count(*) FILTER (WHERE (label = 'Normal') <> (anomaly_type = 'Normal'))"
_ALL_DUP = f"(SELECT coalesce(sum(n - 1), 0) AS n FROM (SELECT count(*) AS n FROM access_log GROUP BY {', '.join(_TYPES)}))"
_ODD = _union(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM access_log WHERE {c} NOT IN ({o.quoted(v)}) GROUP BY {c}"
    for c, v in cfg.EXPECTED_VALUES.items()
)
_CLASSES = _union(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM access_log WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ("label", "anomaly_type")
)
_TYPES_SQL = ", ".join(f"('{c}', '{t}')" for c, t in _TYPES.items())
_PARTS = [
    _found(1, "Schema", "'INFO'", "'table'", "'columns'", str(len(_TYPES)), "NULL", ""),
    _found(1, "Schema", "NULL", "column_name", "'non_null'", "total - missing", "dtype",
           f"FROM ({_MISSING}) JOIN (VALUES {_TYPES_SQL}) AS k(column_name, dtype) USING (column_name)"),
    _found(2, "Missing values", _unless("count(*)"), "'table'", "'columns'", "count(*)", "NULL", f"FROM {_PRESENT}"),
    _found(2, "Missing values", "NULL", "column_name", "'missing_pct'", "missing * 100.0 / total", f"concat(missing, ' ', {_GRADE})", f"FROM {_PRESENT}"),
    _found(3, "Duplicates", "CASE WHEN n = 0 THEN 'PASS' ELSE 'ERROR' END", "'table'", "'duplicates'", "n", "NULL", f"FROM {_ALL_DUP}"),
    _found(4, "Timestamps", "'PASS'", "'event_ts'", "'unparsed'", "0", "NULL", ""),
    _found(4, "Timestamps", "'INFO'", "'event_ts'", "'days'", "date_sub('day', min(event_ts), max(event_ts))",
           "concat(min(event_ts), ' -> ', max(event_ts))", _LOG),
    _found(4, "Timestamps", "'INFO'", "'event_ts'", "'future_events'", "count(*)", "NULL",
           f"{_LOG} WHERE event_ts > TIMESTAMP '{_AS_OF}' HAVING count(*) > 0"),
    *[
        _found(5, "Categories", _unless("count(*)"), f"'{c}'", "'unexpected'", "count(*)", "NULL", f"FROM ({_ODD}) WHERE column_name = '{c}'")
        for c in cfg.EXPECTED_VALUES
    ],
    _found(5, "Categories", "NULL", "concat(column_name, '=', value)", "'unexpected'", "n", "NULL", f"FROM ({_ODD})"),
    _found(5, "Categories", "'INFO'", "'table'", "'columns'", "count(DISTINCT column_name)", "NULL", f"FROM ({_SEEN})"),
    _found(5, "Categories", "NULL", "column_name", "'distinct'", "count(*)", "string_agg(value, ', ' ORDER BY rk) FILTER (WHERE rk <= 8)",
           f"FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY f, value) AS rk FROM ({_SEEN})) GROUP BY column_name"),
    *[
        _found(6, "Ranges", _unless(f"count(*) FILTER (WHERE {c} < 0)"), f"'{c}'", "'negatives'", f"count(*) FILTER (WHERE {c} < 0)",
               f"CAST(min(CASE WHEN {c} < 0 THEN {c} END) AS DOUBLE)", _LOG)
        for c in cfg.NON_NEGATIVE_COLUMNS
    ],
    _found(6, "Ranges", "'INFO'", "'table'", "'columns'", "count(*)", "NULL", "FROM five"),
    *[_found(6, "Ranges", "NULL", "column_name", f"'{m}'", m, "NULL", "FROM five") for m in _FIVE_OUT],
    *[
        _found(6, "Ranges", "NULL", f"'{c}'", "'outliers'",
               f"count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))", "NULL",
               f"FROM access_log, five WHERE column_name = '{c}'")
        for c in _NUMERIC
    ],
    _found(7, "Labels", _unless(_MISMATCHED, "ERROR"), "'label'", "'mismatches'", _MISMATCHED, "NULL", _LOG),
    _found(7, "Labels", "'INFO'", "'table'", "'classes'", "count(*)", "NULL", f"FROM ({_CLASSES})"),
    _found(7, "Labels", "NULL", "concat(column_name, '=', value)", "'events'", "n",
           "printf('%.2f %%', n * 100.0 / (SELECT count(*) FROM access_log))", f"FROM ({_CLASSES})"),
    _found(8, "Entities", "'INFO'", "'table'", "'entities'", "count(DISTINCT entity_id)", "NULL", _LOG),
    _found(8, "Entities", "NULL", "entity_type", "'entities'", "count(DISTINCT entity_id)",
           "printf('%d events, %.1f each', count(*), count(*) / CAST(count(DISTINCT entity_id) AS DOUBLE))", f"{_LOG} GROUP BY entity_type"),
]
FOUND = "found AS (" + _union(_PARTS) + ")"
REPORT = o.sql(
    "SELECT concat(severity, ': ', count(*)) AS line FROM found WHERE severity IS NOT NULL GROUP BY severity "
    "UNION ALL SELECT DISTINCT concat('## ', section) FROM found "
    "UNION ALL SELECT concat(CASE WHEN severity IS NULL THEN '  -' ELSE concat('- [', severity, ']') END, ' ', subject, ': ', metric, ' = ', "
    "printf('%.4f', value), CASE WHEN detail IS NULL THEN '' ELSE concat(' (', detail, ')') END) FROM found",
    _FIVE, FOUND,
)


def all_findings(spark, sf):
    return q.findings(log(spark, sf), F.lit(_AS_OF).cast("timestamp_ntz"))


@query("b15_severity_counts", o.sql("SELECT severity, count(*) AS n FROM found WHERE severity IS NOT NULL GROUP BY severity", _FIVE, FOUND))
def b15(spark, sf):
    """One severity per check, as a reader of the report counts them."""
    return q.severity_counts(all_findings(spark, sf))


@query(
    "b15_findings",
    o.sql(f"SELECT position, section, severity, subject, metric, {o.rdas('value')}, detail FROM found", _FIVE, FOUND),
)
def b15_findings(spark, sf):
    """Every finding with its details: values, samples, first and last time, five numbers, lowest negatives, classes."""
    return all_findings(spark, sf).withColumn("value", F.round("value", 6))


_FILLED = " AND ".join(f"count({c}) > 0" for c in _TYPES)
_SHARE = "count(*) FILTER (WHERE label = 'Anomaly') / CAST(count(*) AS DOUBLE)"


@query(
    "b16_invariants",
    o.sql(
        f"SELECT count(*) > 0 AS has_rows, ({_SHARE} >= 0.01 AND {_SHARE} <= 0.05) AS anomaly_share_ok, "
        f"({_FILLED}) AS no_empty_column, "
        "count(DISTINCT anomaly_type) FILTER (WHERE anomaly_type <> 'Normal') = 7 AS all_attacks_present FROM access_log"
    ),
)
def b16(spark, sf):
    return q.invariants(log(spark, sf))
