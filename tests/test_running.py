"""Running features, group statistics, slices and quantiles."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.operators import drift, enrich, groups, rolling, running
from watchfold.operators.slicing import fit_slices, quantiles, running_sums


def test_streak_resets_on_success(events):
    status = ["Failed", "Failed", "Success", "Failed", "Failed", "Failed", "Success"]
    df = events([{"login_status": s} for s in status])
    got = [x["consecutive_failures"] for x in running.running_features(df).orderBy("event_id").collect()]
    assert got == [1, 2, 0, 1, 2, 3, 0]


@pytest.mark.parametrize("rows_per_slice", [10**6, 2])
def test_ties_are_ordered_by_event_id(events, rows_per_slice):
    import datetime as dt

    same = dt.datetime(2024, 1, 1)
    df = events([{"event_ts": same, "event_id": i, "session_duration_min": float(i)} for i in (3, 1, 2)])
    out = running.running_features(df, running.fit_entity_slices(df, rows_per_slice)).orderBy("event_id").collect()
    assert [x["entity_login_count"] for x in out] == [1, 2, 3]
    assert [x["entity_avg_session"] for x in out] == [1.0, 1.5, 2.0]


def test_single_event_entity(events):
    df = events([{"entity_id": "solo"}, {"entity_id": "e1"}, {"entity_id": "e1"}, {"entity_id": "e1"}])
    out = enrich.enrich(df)
    solo = out.where("entity_id = 'solo'").first()
    assert solo["entity_std_session"] == 0.0 and solo["session_duration_zscore"] == 0.0
    assert solo["time_since_last_login_min"] == 1.0  # the median gap
    assert out.count() == 4


def test_constant_metric_has_zero_zscore_when_sliced(events):
    df = events([{"session_duration_min": 0.1, "bytes_uploaded": 7} for _ in range(200)])
    slices = running.fit_entity_slices(df, 10)
    assert slices is not None
    worst = running.running_features(df, slices).agg(F.max(F.abs("session_duration_zscore"))).first()[0]
    assert worst < 1e-12


def test_features_match_pandas(log):
    out = enrich.enrich(log).toPandas().sort_values(["entity_id", "event_ts", "event_id"])
    by = out.groupby("entity_id")["session_duration_min"]
    mean = by.expanding().mean().reset_index(level=0, drop=True)
    std = by.expanding().std().reset_index(level=0, drop=True).fillna(0)
    np.testing.assert_allclose(out["entity_avg_session"], mean, rtol=1e-12)
    np.testing.assert_allclose(out["entity_std_session"], std, rtol=1e-9, atol=1e-9)
    z = ((out["session_duration_min"] - mean) / std.replace(0, 1)).clip(-10, 10)
    np.testing.assert_allclose(out["session_duration_zscore"], z, rtol=1e-9, atol=1e-9)
    assert len(out) == 1000
    assert out[["hour_sin", "hour_cos"]].abs().max().max() <= 1
    assert (out["resource_access_entropy"] >= 0).all()
    assert np.isfinite(out[enrich.FEATURES].astype(float).to_numpy()).all()
    assert len(enrich.FEATURES) == 27


def test_sliced_features_equal_plain_ones(log):
    """Every entity is cut, including one that holds a third of the rows."""
    skewed = log.withColumn(
        "entity_id", F.when(F.col("event_id") % 3 == 0, "ent_hot").otherwise(F.col("entity_id"))
    )
    plain = enrich.enrich(skewed)
    cut = enrich.enrich(skewed, enrich.fit_context(skewed, rows_per_slice=12))
    a = plain.toPandas().set_index("event_id").sort_index()[enrich.FEATURES].astype(float)
    b = cut.toPandas().set_index("event_id").sort_index()[enrich.FEATURES].astype(float)
    np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-9)


def test_bursts_are_cut_again(spark):
    """Nearly all rows in a thousandth of the range: slices must still be small."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.uniform(0, 1, 4000), [1e6]])
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "x": x}))
    slices = fit_slices(df, ["k"], F.col("x"), 100)
    sizes = slices.assign(df).groupBy("_slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 200
    summed = running_sums(df, ["k"], ["x"], {"n": F.lit(1)}, slices).orderBy("x").select("n").toPandas()["n"]
    assert list(summed) == list(range(1, 4002))


@pytest.mark.parametrize("rows_per_slice", [10**6, 50])
def test_quantiles_match_numpy(spark, rows_per_slice):
    rng = np.random.default_rng(7)
    a, b = rng.lognormal(3, 2, 700), rng.integers(0, 5, 300).astype(float)
    pdf = pd.DataFrame({"g": ["a"] * 700 + ["b"] * 300 + ["c"], "v": np.concatenate([a, b, [4.0]])})
    probs = {"p02": 0.02, "q1": 0.25, "med": 0.5, "q3": 0.75}
    got = quantiles(spark.createDataFrame(pdf), ["g"], "v", probs, rows_per_slice=rows_per_slice).toPandas().set_index("g")
    for g, v in (("a", a), ("b", b), ("c", np.array([4.0]))):
        np.testing.assert_allclose(got.loc[g, list(probs)].astype(float), np.quantile(v, list(probs.values())), rtol=1e-12)
    whole = quantiles(spark.createDataFrame(pdf), [], "v", {"med": 0.5}, rows_per_slice=rows_per_slice).first()["med"]
    np.testing.assert_allclose(whole, np.median(pdf["v"]))


def test_missing_keys_and_values(events):
    df = events([{"department": None}, {"resource_accessed": None, "geo_location": None, "entity_id": "x"}, {}])
    out = enrich.enrich(df).orderBy("event_id").collect()
    assert out[0]["peer_avg_session"] is None
    assert out[1]["resource_access_entropy"] is None and out[1]["unique_resources_cumulative"] == 0


def test_peers_join_is_a_broadcast(log):
    plan = groups.attach_peers(log, groups.fit_peers(log))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_running_features_shuffle_once(log):
    plan = running.running_features(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_entity_order_split(log):
    out = drift.split_by_entity_order(log).toPandas().sort_values(["entity_id", "event_ts", "event_id"])
    assert list(out["is_reference"]) == [True] * 700 + [False] * 300


def test_slices_of_any_shape(spark):
    """Halving values, one single value and a hot group of them: no slice holds over twice the limit."""
    rows = [("half", 0.5**i, i) for i in range(1000)] + [("same", 1.0, i) for i in range(1000)]
    rows += [("two", float(i % 2), i) for i in range(700)] + [("few", 3.0, 1)]
    df = spark.createDataFrame(rows, "k string, v double, id long")
    slices = fit_slices(df, ["k"], F.col("v"), 50, tie=F.col("id"))
    cut = slices.assign(df)
    assert cut.groupBy("k", "_slice").count().agg({"count": "max"}).first()[0] <= 100
    order = Window.partitionBy("k").orderBy("v", "id")
    got = running_sums(df, ["k"], ["v", "id"], {"s": F.col("id")}, slices)
    want = df.withColumn("s", F.sum("id").over(order))
    assert got.select("k", "id", "s").exceptAll(want.select("k", "id", "s")).isEmpty() and got.count() == len(rows)


def test_look_back_counts_equal_times(events):
    import datetime as dt

    at = dt.datetime(2024, 1, 1)
    df = events([{"event_ts": at, "resource_accessed": x} for x in "aab"] + [{"event_ts": at + dt.timedelta(days=7), "resource_accessed": "c"}])
    for limit in (10**6, 2):
        rates = {r["event_id"]: r["login_frequency_7d"] for r in rolling.rolling_rates(df, 7, limit).collect()}
        assert rates == {0: 3, 1: 3, 2: 3, 3: 4}
        distinct = {r["event_id"]: r["n"] for r in rolling.rolling_distinct(df, "resource_accessed", "n", 7, limit).collect()}
        assert distinct == {0: 2, 1: 2, 2: 2, 3: 3}
        entropy = rolling.expanding_entropy(df, limit).orderBy("event_id").collect()
        assert [r[1] for r in entropy] == pytest.approx([0.9182958340544896] * 3 + [1.5])


def test_sums_of_slices_are_joined_with_cuts_only(spark):
    rows = spark.range(400).select((F.col("id") % 2).alias("k"), F.col("id").alias("x"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("y"))
    slices = fit_slices(rows, ["k"], F.col("x"), 5)
    summed = running_sums(rows, ["k"], ["x"], {"n": F.lit(1), "total": F.col("y")}, slices)
    assert summed._jdf.queryExecution().optimizedPlan().toString().count("Join") == len(slices.levels)
    plain = running_sums(rows, ["k"], ["x"], {"n": F.lit(1), "total": F.col("y")})
    assert summed.dtypes == plain.dtypes and summed.exceptAll(plain).isEmpty() and plain.exceptAll(summed).isEmpty()
