"""Properties of the models, metrics, attributions and drift."""

import pickle
import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import TINY
from watchfold.operators import classify as cl
from watchfold.operators import drift, encoding, explain, forest, metrics
from watchfold.operators.sparse import sparse
from watchfold.plans.batch import run_batch
from watchfold.sources.access_log import read_access_log

def truth():
    return F.col("label") == "Anomaly"


def test_matrix(batch):
    names = batch.fitted.forest.features
    assert len(names) > 100
    assert not {"event_id", "entity_id", "source_ip", "label", "anomaly_type"} & set(names)
    cells = batch.matrix.select(F.explode(F.arrays_zip("features.at", "features.x")).alias("c")).select("c.*")
    ends = cells.agg(F.min("at"), F.max("at"), F.count_if(F.isnan("x") | (F.col("x") == 0))).first()
    assert ends[0] >= 0 and ends[1] < len(names) and ends[2] == 0
    # The columns of the dense form, in the same order.
    dense = encoding.apply_encoder(batch.profiled, batch.fitted.encoder)
    assert encoding.feature_names(dense) == list(names)
    wide = encoding.with_vector(dense, list(names)).select("event_id", sparse(F.col("features")).alias("features"))
    assert wide.exceptAll(batch.matrix.select("event_id", "features")).isEmpty()


def test_detection(batch):
    out = batch.scored.agg(
        F.count(F.lit(1)), F.collect_set("prediction"), F.avg("is_anomaly"), F.min("anomaly_score"), F.max("anomaly_score")
    ).first()
    assert out[0] == 10_000 and set(out[1]) == {-1, 1}
    assert 0.005 <= out[2] <= 0.10
    assert out[3] == 0.0 and out[4] == pytest.approx(100.0)
    m = metrics.binary_metrics(batch.scored, truth(), F.col("prediction") == -1).first()
    assert m["fpr"] < 0.05 and m["tp"] > 0
    assert metrics.roc_auc(batch.scored, truth(), "anomaly_score").first()[0] > 0.65


def test_forest_is_repeatable_and_samples_without_replacement(batch):
    vectors = batch.matrix
    names = list(batch.fitted.forest.features)
    a = forest.fit_forest(vectors, names, trees=7, sample=64)
    b = forest.fit_forest(vectors, names, trees=7, sample=64)
    assert a.nodes.exceptAll(b.nodes).isEmpty()
    drawn = forest.sample_trees(vectors, 10_000, 7, 64, 42)
    sizes = drawn.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("d")).collect()
    assert len(sizes) == 7 and all(s["n"] == s["d"] == 64 for s in sizes)


@pytest.mark.parametrize("rows", [40, 1_000, 60_000])
def test_samples_follow_one_law(spark, rows):
    """From tables smaller than the sample to far larger ones: exact sizes, and trees that draw independently."""
    df = spark.range(rows).select(F.col("id").alias("event_id"), F.array(F.lit(1.0)).alias("features"))
    drawn = forest.sample_trees(df, rows, 60, 50, 7).toPandas()
    size = min(50, rows)
    assert (drawn.groupby("tree")["event_id"].nunique() == size).all() and len(drawn) == 60 * size
    # Rows are shared by pairs of trees as often as independent draws share them.
    shared = drawn.merge(drawn, on="event_id").query("tree_x < tree_y").shape[0]
    expected = 60 * 59 / 2 * size * size / rows
    assert abs(shared - expected) < 5 * np.sqrt(expected) + 1e-9 if rows > 50 else shared == expected
    # No part of the table is preferred.
    if rows > 50:
        assert abs(drawn["event_id"].mean() / rows - 0.5) < 0.03


def test_too_few_candidates_are_drawn_anew(spark, monkeypatch):
    monkeypatch.setattr(forest, "_OVERSAMPLE", 0.3)
    df = spark.range(5_000).select(F.col("id").alias("event_id"), F.array(F.lit(1.0)).alias("features"))
    drawn = forest.sample_trees(df, 5_000, 9, 40, 7)
    assert drawn.count() == 9 * 40 and drawn.distinct().count() == 9 * 40


def test_isolation_score_of_an_outlier(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(400, 3)), [[9.0, 9.0, 9.0]]])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "event_id long, features array<double>")
    f = forest.fit_forest(df, ["a", "b", "c"], trees=50)
    scored = forest.isolation(df, f)
    top = scored.orderBy(F.desc("isolation")).first()
    assert top["event_id"] == 400 and 0 < top["isolation"] < 1
    f = forest.calibrate(f, scored)
    assert forest.score_forest(scored, f).where("prediction = -1").count() == pytest.approx(401 * 0.02, abs=1)


def test_classifier(batch):
    assert len(batch.fitted.classifier.classes) == 7
    rows = cl.training_rows(batch.matrix)
    said = cl.classify(rows, batch.fitted.classifier)
    assert metrics.macro_f1(metrics.confusion(said, "anomaly_type", "attack")) > 0.90
    flagged = batch.scored.groupBy("prediction").agg(F.count_if(F.col("attack") == "Normal").alias("n")).collect()
    assert {r["prediction"]: r["n"] for r in flagged}[-1] == 0


def test_attributions_add_up(batch, spark):
    model = batch.fitted.classifier
    flagged = batch.scored.where("prediction = -1").select("event_id", "attack")
    rows = explain.attribute(batch.matrix.join(flagged, "event_id"), model)
    start = F.array(*[F.lit(v) for v in explain.expected_output(model, spark)])
    code = cl.encode_class("attack", list(model.classes)).cast("int")
    total = F.aggregate("shap", F.lit(0.0), lambda a, x: a + x)
    gap = cl.outputs(F.col("features"), model)[code] - start[code] - total
    assert rows.agg(F.max(F.abs(gap))).first()[0] < 1e-6


def _brute_shapley(x, table, cls, d):
    """Shapley values by their definition, over all subsets of features."""
    from itertools import combinations
    from math import factorial

    def value(known):
        total = 0.0
        for p in table.paths:
            for features, low, high, kept, value in zip(p.features, p.low, p.high, p.kept, p.value):
                w = value[cls]
                for f, lo, hi, z in zip(table.used[features], low, high, kept):
                    w *= float(lo < x[f] <= hi) if f in known else z
                total += w
        return total

    phi = np.zeros(d)
    for i in range(d):
        rest = [j for j in range(d) if j != i]
        for k in range(d):
            for s in combinations(rest, k):
                weight = factorial(k) * factorial(d - k - 1) / factorial(d)
                phi[i] += weight * (value(set(s) | {i}) - value(set(s)))
    return phi


@pytest.mark.parametrize("model", ["random_forest", "boosted"])
def test_attributions_match_the_definition(spark, model):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 4))
    kind = np.where(x[:, 0] + x[:, 1] > 0.5, "A", np.where(x[:, 2] > 0, "B", "C"))
    df = spark.createDataFrame(
        [(i, [float(v) for v in r], "Anomaly", str(k)) for i, (r, k) in enumerate(zip(x, kind))],
        "event_id long, features array<double>, label string, anomaly_type string",
    )
    fitted = cl.train_model(df, list("abcd"), model, cl.Effort(trees=4, tree_depth=4, rounds=2, max_depth=3))
    table = explain.path_table(fitted)
    got = np.zeros((6, 4))
    got[:, table.used] = explain.shapley(x[:6][:, table.used], np.array([0, 1, 2, 0, 1, 2]), table)
    for i in range(6):
        np.testing.assert_allclose(got[i], _brute_shapley(x[i], table, i % 3, 4), atol=1e-9)


def test_paths_are_laid_out_where_they_are_used(spark, monkeypatch):
    """What the driver makes and sends is the node table as arrays; groups of trees and of leaves give the sums of all."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 6))
    df = spark.createDataFrame(
        [(i, [float(v) for v in r], "Anomaly", "ABC"[k]) for i, (r, k) in enumerate(zip(x, rng.integers(0, 3, 600)))],
        "event_id long, features array<double>, label string, anomaly_type string",
    )
    fitted = cl.train_model(df, list("abcdef"), "random_forest", cl.Effort(trees=6, tree_depth=12))
    table = explain.path_table(fitted)
    assert len(pickle.dumps(table)) < 64 * fitted.nodes.count() + 4000
    codes = np.arange(40) % 3
    whole = explain.shapley(x[:40][:, table.used], codes, table)
    monkeypatch.setattr(explain, "LEAVES", 100)
    monkeypatch.setattr(explain, "_AT_ONCE", 20_000)
    assert len(list(table.paths)) > 12
    np.testing.assert_allclose(explain.shapley(x[:40][:, table.used], codes, table), whole, atol=1e-12)


def test_comparison_reports_failures(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(
        [(i, [float(v) for v in rng.normal(size=2) + (i % 2) * 3], "Anomaly", "AB"[i % 2]) for i in range(40)],
        "event_id long, features array<double>, label string, anomaly_type string",
    )
    real = cl.candidates(cl.Effort(trees=3, tree_depth=2))
    broken = {"random_forest": real["random_forest"], "boosted": lambda: 1 / 0}
    monkeypatch.setattr(cl, "candidates", lambda *a: broken)
    out = {r["model"]: r for r in cl.compare_models(df, folds=2).collect()}
    assert out["random_forest"]["best"] and out["random_forest"]["mean_f1"] > 0.8
    assert out["boosted"]["mean_f1"] is None and "division" in out["boosted"]["error"]
    assert len(out["random_forest"]["fold_scores"]) == 2


def test_comparison_of_chosen_candidates_with_one_that_cannot_grow(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame(
        [(i, [float(v) for v in rng.normal(size=2) + (i % 2) * 3], "Anomaly", "AB"[i % 2]) for i in range(240)],
        "event_id long, features array<double>, label string, anomaly_type string",
    )
    real = cl.candidates(cl.Effort(rounds=5, max_depth=3))
    broken = {**real, "boosted": lambda: cl.Plan(**{**real["boosted"]().__dict__, "leaves": "few"})}
    monkeypatch.setattr(cl, "candidates", lambda *a: broken)
    out = {r["model"]: r for r in cl.compare_models(df, folds=3, names=["boosted", "boosted_balanced"]).collect()}
    assert set(out) == {"boosted", "boosted_balanced"} and out["boosted"]["error"]
    assert out["boosted_balanced"]["best"] and out["boosted_balanced"]["mean_f1"] > 0.7


def test_folds_are_stratified(batch):
    rows = cl.training_rows(batch.matrix)
    sizes = cl.stratified_folds(rows).groupBy("anomaly_type", "fold").count().toPandas()
    spread = sizes.groupby("anomaly_type")["count"].agg(lambda s: s.max() - s.min())
    assert (spread <= 1).all() and sizes["fold"].nunique() == 5


def _scores(spark, hits, score):
    pdf = pd.DataFrame({"event_id": range(len(hits)), "t": list(map(bool, hits)), "s": list(map(float, score))})
    return spark.createDataFrame(pdf)


def test_metric_edges(spark):
    df = _scores(spark, [1] * 5, range(5))
    assert metrics.roc_auc(df, F.col("t"), "s").first()[0] == 0.0
    assert metrics.top_share_recall(df, F.col("t"), "s").first()["recall"] == 0.0  # under 100 rows
    none = metrics.binary_metrics(df, ~F.col("t"), F.col("s") < 0).first()
    assert none["precision"] == none["recall"] == none["f1"] == 0.0


@pytest.mark.parametrize("rows_per_slice", [10**6, 40])
def test_metrics_match_brute_force(spark, rows_per_slice):
    rng = np.random.default_rng(11)
    hit = rng.random(1500) < 0.1
    score = np.round(rng.normal(size=1500) + hit, 1)  # many ties
    score[:500] = 3.0  # a third of the rows share one score
    df = _scores(spark, hit, score)
    pos, neg = score[hit], score[~hit]
    wins = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert metrics.roc_auc(df, F.col("t"), "s", rows_per_slice).first()[0] == pytest.approx(wins, abs=1e-12)
    order = np.lexsort((np.arange(1500), -score))[: int(0.2 * 1500)]
    got = metrics.top_share_recall(df, F.col("t"), "s", 0.2, rows_per_slice).first()
    assert got["found"] == hit[order].sum() and got["budget"] == 300


@pytest.mark.parametrize("rows_per_slice", [10**6, 100])
def test_drift_of_shifted_grids(spark, rows_per_slice):
    """Even grids: the distance of a grid and of one moved by a share of its length is that share."""
    grid = pd.DataFrame({"moved": np.arange(800) / 800, "still": np.arange(800) * 2.0, "untracked": np.zeros(800)})
    now = pd.DataFrame({"moved": np.arange(400) / 400 + 0.35, "still": np.arange(400) * 4.0 + 1, "untracked": np.ones(400)})
    fitted = drift.fit_reference(spark.createDataFrame(grid), ["moved", "still"])
    got = {r["feature"]: r for r in drift.detect_drift(fitted, spark.createDataFrame(now), rows_per_slice=rows_per_slice).collect()}
    assert set(got) == {"moved", "still"}
    assert got["moved"]["is_drifting"] and not got["still"]["is_drifting"]
    assert got["moved"]["ks_statistic"] == pytest.approx(0.35, abs=0.003)
    assert got["still"]["ks_statistic"] <= 1 / 400 and got["still"]["p_value"] == 1.0
    assert got["moved"]["reference_mean"] == pytest.approx(799 / 1600) and got["moved"]["current_mean"] == pytest.approx(0.35 + 399 / 800)


def test_drift_skips_features_of_one_side(spark):
    ref = drift.fit_reference(spark.createDataFrame([(1.0, 2.0)] * 20, "a double, b double"), ["a", "b", "c"])
    out = drift.detect_drift(ref, spark.createDataFrame([(1.0,)] * 10, "a double")).collect()
    assert [r["feature"] for r in out] == ["a"] and out[0]["p_value"] == 1.0


def test_candidates_on_few_rows_grow_beside_the_comparison(spark, monkeypatch):
    """All fits have begun before the comparison ends; a loser that fails does no harm."""
    begun, all_begun = [], threading.Event()
    train, compare = cl.train_model, cl.compare_models

    def training(rows, features, name, *rest):
        begun.append(name)
        if len(begun) == 3:
            all_begun.set()
        if name == "random_forest":
            raise ValueError("not this one")
        return train(rows, features, name, *rest)

    def comparing(rows, effort):
        assert all_begun.wait(60)
        return compare(rows, effort, names=["boosted"])

    monkeypatch.setattr(cl, "train_model", training)
    monkeypatch.setattr(cl, "compare_models", comparing)
    out = run_batch(read_access_log(spark, TINY), trees=10, effort=cl.Effort(trees=2, tree_depth=2, rounds=2, max_depth=2))
    assert out.fitted.classifier.name == "boosted" and sorted(begun) == ["boosted", "boosted_balanced", "random_forest"]
