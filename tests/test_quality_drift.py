"""Data-quality findings, and drift of small and of sketched samples."""

import io
from contextlib import redirect_stdout
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchfold.operators import drift, quality


def _brute_p(d, n, m):
    """Share of all orderings of n + m values whose distance is at least d."""
    hits = total = 0
    for places in combinations(range(n + m), n):
        mine = np.zeros(n + m, bool)
        mine[list(places)] = True
        gap = np.abs(np.cumsum(mine) / n - np.cumsum(~mine) / m).max()
        hits += gap >= d - 1e-9
        total += 1
    return hits / total


@pytest.mark.parametrize("n,m", [(1, 1), (2, 5), (3, 3), (4, 7), (5, 6), (8, 8)])
def test_exact_p_value_counts_orderings(n, m):
    distances = {abs(i / n - j / m) for i in range(n + 1) for j in range(m + 1)}
    for d in sorted(distances)[:: max(1, len(distances) // 6)]:
        assert drift.exact_p_value(d, n, m) == pytest.approx(_brute_p(d, n, m) if d else 1.0, abs=1e-12)


def test_exact_and_series_agree_for_many_rows():
    assert 0 < drift.exact_p_value(0.02, 9000, 7000) < 1
    lam = 0.02 * np.sqrt(9000 * 7000 / 16000)
    series = 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 50))
    assert drift.exact_p_value(0.02, 9000, 7000) == pytest.approx(series, abs=0.02)


def test_small_samples_are_tested_exactly(spark):
    side = lambda xs: spark.createDataFrame([(float(x),) for x in xs], "login_hour double")
    a, b = [1, 2, 3, 4, 5], [4.5, 6, 7, 8]
    out = drift.detect_drift(drift.fit_reference(side(a), ["login_hour"]), side(b), features=["login_hour"]).first()
    assert out["ks_statistic"] == pytest.approx(0.8) and out["p_value"] == pytest.approx(_brute_p(0.8, 5, 4))


def test_merged_sketches_stand_for_all_rows(spark):
    rng = np.random.default_rng(4)
    day = lambda k: spark.createDataFrame([(float(x),) for x in rng.normal(k / 10, 1, 4000)], "v double")
    days, now = [day(k) for k in range(4)], spark.createDataFrame([(float(x),) for x in rng.normal(0.5, 1.2, 5000)], "v double")
    rows = days[0].union(days[1]).union(days[2]).union(days[3])
    exact = drift.detect_drift(drift.fit_reference(rows, ["v"]), now, features=["v"]).first()
    merged = drift.merge_sketches(*[drift.fit_sketch(d, ["v"]) for d in days])
    rough = drift.sketched_drift(merged, drift.fit_sketch(now, ["v"])).first()
    assert abs(rough["ks_statistic"] - exact["ks_statistic"]) <= 2 * drift.SKETCH_ERROR
    assert rough["reference_mean"] == pytest.approx(exact["reference_mean"], abs=1e-3) and rough["is_drifting"]
    assert merged.select(F.octet_length("sketch")).first()[0] < 60_000


def test_duplicates_by_fingerprint(spark):
    rows = [(1, None, "a", 0.0), (1, None, "a", -0.0), (1, "a", None, 0.0), (2, "b", "b", None), (2, "b", "b", None), (2, "b", "b", None)]
    df = spark.createDataFrame(rows, "i int, x string, y string, z double")
    assert quality.duplicate_rows(df).first()["duplicates"] == 3
    assert quality.duplicate_rows(df, ["i"]).first()["duplicates"] == 4
    assert quality.duplicate_rows(df.limit(0)).first()["duplicates"] == 0
    plan = io.StringIO()
    with redirect_stdout(plan):
        quality.duplicate_rows(df).explain("formatted")
    exchanged = [line for line in plan.getvalue().splitlines() if "Keys [2]: [_a" in line]
    assert exchanged  # the rows are first counted by their two hashes


def test_one_severity_per_check(events):
    df = events([{"session_duration_min": -2.5}, {"anomaly_type": "Brute Force"}, {"browser": None}, {"entity_type": "Robot"}])
    found = quality.findings(df, F.lit("2023-12-31").cast("timestamp_ntz"))
    heads = {(r["section"], r["subject"], r["metric"]): r["severity"] for r in found.where("severity IS NOT NULL").collect()}
    assert heads["Missing values", "table", "columns"] == "WARNING"
    assert heads["Ranges", "session_duration_min", "negatives"] == "WARNING"
    assert heads["Ranges", "bytes_uploaded", "negatives"] == "PASS"
    assert heads["Labels", "label", "mismatches"] == "ERROR"
    assert heads["Categories", "entity_type", "unexpected"] == "WARNING" and heads["Categories", "label", "unexpected"] == "PASS"
    assert heads["Timestamps", "event_ts", "future_events"] == "INFO" and heads["Timestamps", "event_ts", "unparsed"] == "PASS"
    details = {(r["subject"], r["metric"]): r for r in found.where("severity IS NULL").collect()}
    assert details["entity_type=Robot", "unexpected"]["value"] == 1
    assert details["entity_type", "distinct"]["detail"] == "User, Robot"
    assert details["session_duration_min", "lowest"]["value"] == -2.5
    lines = [r["line"] for r in quality.report_lines(found).collect()]
    assert "## Ranges" in lines and "- [WARNING] session_duration_min: negatives = 1.0000 (-2.5)" in lines
    assert sum(int(x.split(": ")[1]) for x in lines[:4] if not x.startswith("#")) == len(heads)


def test_sketches_of_all_days_in_one_pass(spark):
    """A table of baselines, one per day, holds what a baseline fitted for each day alone says."""
    rows = spark.range(3000).select((F.col("id") % 3).alias("day"), (F.col("id") * 7 % 1009).cast("double").alias("v"))
    rows = rows.withColumn("u", F.when(F.col("day") == 0, F.lit(float("nan"))).otherwise(F.col("v")))
    days = drift.fit_sketch(rows, ["v", "u", "missing"], by=["day"])
    alone = [drift.fit_sketch(rows.where(F.col("day") == d), ["v", "u"]).withColumn("day", F.lit(d)) for d in range(3)]
    said = lambda t: sorted((r["day"], r["feature"], r["n"], r["total"]) for r in t.collect())
    assert said(days) == sorted(x for t in alone for x in said(t)) and len(said(days)) == 5
    merged = {r["feature"]: (r["n"], r["total"]) for r in drift.merge_sketches(days).collect()}
    assert merged["v"] == (3000, rows.agg(F.sum("v")).first()[0]) and merged["u"][0] == 2000
