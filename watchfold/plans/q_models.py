"""Registered queries: anomaly model, classifiers, attributions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.operators import classify as cl
from watchfold.operators import explain, forest, metrics
from watchfold.operators.trees import NODES
from watchfold.plans import analyst
from watchfold.plans import oracle as o
from watchfold.plans.registry import (
    batch, log, prepared, profiled, query, r, rule_class, rule_decision, rule_score, rule_scored, shared,
)
from watchfold.session import keep


def _vectors(spark, sf):
    return prepared(spark, sf).matrix


def _trees(spark, sf):
    """The isolation forest as the batch job grows it."""
    return shared(spark, sf, "trees", lambda: forest.fit_forest(_vectors(spark, sf), prepared(spark, sf).names))


def _attacks(spark, sf):
    return shared(spark, sf, "attacks", lambda: keep(cl.training_rows(_vectors(spark, sf)), "attacks"))


# --- anomaly model -------------------------------------------------------------


_ROWS = "(SELECT count(*) FROM access_log)"


@query(
    "h01_forest_nodes",
    o.sql(
        f"SELECT CAST(tree AS INT) AS tree, CAST(least(256, {_ROWS}) AS INT) AS sampled, least(256, {_ROWS}) AS in_leaves, "
        f"true AS deep_enough, true AS ordered FROM (SELECT unnest(range({cfg.FOREST_TREES})) AS tree)"
    ),
)
def h01(spark, sf):
    """Trees grown from the model matrix: all sampled rows reach leaves, within the depth; children hold their parents' rows."""
    nodes = _trees(spark, sf).nodes
    most = F.ceil(F.log2(F.lit(float(cfg.FOREST_SAMPLE))))
    side = lambda c: nodes.select("tree", F.col("node").alias(c), F.col("size").alias(f"size_{c}"))
    joined = nodes.join(side("left_node"), ["tree", "left_node"], "left").join(side("right_node"), ["tree", "right_node"], "left")
    whole = (F.col("feature") < 0) | (F.col("size") == F.col("size_left_node") + F.col("size_right_node"))
    return joined.groupBy("tree").agg(
        F.max("size").alias("sampled"),
        F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("in_leaves"),
        (F.max("depth") <= most).alias("deep_enough"),
        F.bool_and(whole).alias("ordered"),
    )


@query("h02_isolation", o.sql("SELECT count(*) AS n, CAST(0 AS BIGINT) AS outside, true AS anomalies_score_higher FROM access_log"))
def h02(spark, sf):
    """Scores of the fitted forest: all in (0, 1], higher for anomalies on average."""
    out = forest.isolation(_vectors(spark, sf), _trees(spark, sf))
    mean = lambda label: F.avg(F.when(F.col("label") == label, F.col("isolation")))
    return out.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("isolation") <= 0) | (F.col("isolation") > 1)).alias("outside"),
        (mean("Anomaly") > mean("Normal")).alias("anomalies_score_higher"),
    )


# Two trees over (failed_attempts, geo_velocity_kmph, bytes_uploaded), written out: any SQL engine can score them.
_LITERAL = ["failed_attempts", "geo_velocity_kmph", "bytes_uploaded"]
_LITERAL_NODES = [
    (0, 0, 0, 3.5, 1, 2, 8, 0), (0, 1, 2, 2000.0, 3, 4, 6, 1), (0, 2, -1, 0.0, -1, -1, 2, 1),
    (0, 3, -1, 0.0, -1, -1, 5, 2), (0, 4, -1, 0.0, -1, -1, 1, 2),
    (1, 0, 1, 500.0, 1, 2, 8, 0), (1, 1, -1, 0.0, -1, -1, 7, 1), (1, 2, -1, 0.0, -1, -1, 1, 1),
]


def _depth(depth: int, size: int) -> str:
    c = f"(2 * (ln({size} - 1) + {np.euler_gamma!r}) - 2 * ({size} - 1) / CAST({size} AS DOUBLE))"
    return f"({depth} + {c if size > 2 else 1 if size == 2 else 0})"


@query(
    "h02_isolation_literal",
    o.sql(
        f"SELECT event_id, {o.rd(f'power(CAST(2 AS DOUBLE), -(a + b) / 2 / {_depth(0, 8)})')} AS isolation FROM (SELECT event_id, "
        f"CASE WHEN failed_attempts > 3.5 THEN {_depth(1, 2)} WHEN bytes_uploaded <= 2000 THEN {_depth(2, 5)} ELSE {_depth(2, 1)} END AS a, "
        f"CASE WHEN geo_velocity_kmph <= 500 THEN {_depth(1, 7)} ELSE {_depth(1, 1)} END AS b FROM access_log)"
    ),
)
def h02_literal(spark, sf):
    """The scorer on a forest of two known trees."""
    trees = forest.Forest(spark.createDataFrame(_LITERAL_NODES, forest.NODES), tuple(_LITERAL), 8)
    rows = log(spark, sf).select("event_id", F.array(*[F.col(c).cast("double") for c in _LITERAL]).alias("features"))
    return forest.isolation(rows, trees).select("event_id", r("isolation"))


_DECIDED = f"decided AS (SELECT *, {o.RULE_DECISION} AS decision FROM access_log)"


@query(
    "h03_predictions",
    o.sql("SELECT event_id, CASE WHEN decision < 0 THEN -1 ELSE 1 END AS prediction FROM decided", _DECIDED),
)
def h03(spark, sf):
    return log(spark, sf).select("event_id", forest.prediction(rule_decision()).alias("prediction"))


_RESCALED = "({hi} - decision) / ({hi} - {lo}) * 100"


@query(
    "h04_rescaled",
    o.sql(
        "SELECT event_id, "
        + o.rd(_RESCALED.format(hi="(SELECT max(decision) FROM decided)", lo="(SELECT min(decision) FROM decided)"))
        + " AS anomaly_score FROM decided",
        _DECIDED,
    ),
)
def h04(spark, sf):
    rows = log(spark, sf).withColumn("decision", rule_decision())
    return forest.rescale_column(rows, "decision").select("event_id", r("anomaly_score"))


@query(
    "h05_rescaled_live",
    o.sql(
        f"SELECT event_id, {o.rd('least(100, greatest(0, (CAST(0.2 AS DOUBLE) - decision) / (CAST(0.2 AS DOUBLE) + CAST(0.3 AS DOUBLE)) * 100))')} "
        "AS anomaly_score FROM decided",
        _DECIDED,
    ),
)
def h05(spark, sf):
    return log(spark, sf).select("event_id", r(forest.rescale_live(rule_decision())).alias("anomaly_score"))


_CONFUSED = (
    "SELECT count(*) FILTER (WHERE label = 'Anomaly' AND decision < 0) AS tp, "
    "count(*) FILTER (WHERE label <> 'Anomaly' AND decision < 0) AS fp, "
    "count(*) FILTER (WHERE label = 'Anomaly' AND decision >= 0) AS fn, "
    "count(*) FILTER (WHERE label <> 'Anomaly' AND decision >= 0) AS tn FROM decided"
)


@query(
    "h06_detection_metrics",
    o.sql(
        f"SELECT tp, fp, fn, tn, {o.rd('tp / CAST(tp + fp AS DOUBLE)', 4)} AS precision, "
        f"{o.rd('tp / CAST(tp + fn AS DOUBLE)', 4)} AS recall, {o.rd('2 * tp / CAST(2 * tp + fp + fn AS DOUBLE)', 4)} AS f1, "
        f"{o.rd('fp / CAST(fp + tn AS DOUBLE)', 4)} AS fpr FROM ({_CONFUSED})",
        _DECIDED,
    ),
)
def h06(spark, sf):
    return metrics.binary_metrics(log(spark, sf), F.col("label") == "Anomaly", rule_decision() < 0)


_SCORES = f"scores AS (SELECT event_id, label = 'Anomaly' AS truth, {o.RULE_SCORE} AS s FROM access_log)"
_AUC = o.sql(
    f"SELECT {o.rd('sum(pos * (below - neg / 2.0)) / (sum(pos) * sum(neg))')} AS roc_auc FROM ("
    "SELECT pos, neg, sum(neg) OVER (ORDER BY s) AS below FROM (SELECT s, "
    "CAST(count(*) FILTER (WHERE truth) AS DOUBLE) AS pos, CAST(count(*) FILTER (WHERE NOT truth) AS DOUBLE) AS neg "
    "FROM scores GROUP BY s))",
    _SCORES,
)


def _scores(spark, sf):
    return log(spark, sf).select("event_id", (F.col("label") == "Anomaly").alias("truth"), rule_score().alias("s"))


@query("h07_roc_auc", _AUC)
def h07(spark, sf):
    return metrics.roc_auc(_scores(spark, sf), F.col("truth"), "s").select(r("roc_auc"))


@query("h07_roc_auc_split", _AUC)
def h07_split(spark, sf):
    """The distinct scores cut into slices, as when there are very many."""
    return metrics.roc_auc(_scores(spark, sf), F.col("truth"), "s", rows_per_slice=300).select(r("roc_auc"))


_TOP = o.sql(
    "SELECT CAST(floor(0.01 * (SELECT count(*) FROM scores)) AS INT) AS budget, count(*) FILTER (WHERE truth) AS found, "
    f"{o.rd('count(*) FILTER (WHERE truth) / CAST((SELECT count(*) FROM scores WHERE truth) AS DOUBLE)')} AS recall "
    "FROM (SELECT truth, row_number() OVER (ORDER BY s DESC, event_id) AS rk FROM scores) "
    "WHERE rk <= floor(0.01 * (SELECT count(*) FROM scores))",
    _SCORES,
)


@query("h08_top_share_recall", _TOP)
def h08(spark, sf):
    return metrics.top_share_recall(_scores(spark, sf), F.col("truth"), "s").select("budget", "found", r("recall"))


@query("h08_top_share_recall_split", _TOP)
def h08_split(spark, sf):
    """The budget cut by running counts instead of a top-k, as when it is large."""
    out = metrics.top_share_recall(_scores(spark, sf), F.col("truth"), "s", rows_per_slice=300)
    return out.select("budget", "found", r("recall"))


@query(
    "h09_detection_run",
    o.sql(
        "SELECT count(*) FILTER (WHERE label = 'Anomaly') AS anomalies, count(*) AS n, true AS flagged_rate, true AS fpr, "
        "true AS roc_auc, true AS found FROM access_log"
    ),
)
def h09(spark, sf):
    """Fit, score, predict and measure in one go, on the real forest: the thresholds that the measures have to meet."""
    d = batch(spark, sf).detection
    rows = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return d.select(
        (F.col("tp") + F.col("fn")).alias("anomalies"),
        rows.alias("n"),
        ((F.col("tp") + F.col("fp")) / rows).between(0.005, 0.10).alias("flagged_rate"),
        (F.col("fpr") < 0.05).alias("fpr"),
        (F.col("roc_auc") > 0.65).alias("roc_auc"),
        (F.col("tp") > 0).alias("found"),
    )


# --- attack classification -----------------------------------------------------


@query(
    "i01_training_rows",
    o.sql("SELECT event_id, anomaly_type FROM access_log WHERE label = 'Anomaly' AND anomaly_type <> 'Normal'"),
)
def i01(spark, sf):
    return cl.training_rows(log(spark, sf)).select("event_id", "anomaly_type")


_FITTED = "SELECT anomaly_type AS class, count(*) AS support, true AS good FROM known GROUP BY anomaly_type"
_KNOWN = "known AS (SELECT * FROM access_log WHERE label = 'Anomaly' AND anomaly_type <> 'Normal')"


def _quality(said):
    """Per class its rows, and whether the macro F1 of all is over 0.9; under 100 rows no split may be allowed."""
    report = metrics.classification_report(metrics.confusion(said, "anomaly_type", "attack"))
    good = report.where("class = 'macro avg'").select((F.col("f1_score") > 0.9) | (F.col("support") < 100)).scalar()
    return report.where(~F.col("class").isin("accuracy", "macro avg", "weighted avg") & (F.col("support") > 0)).select(
        "class", "support", good.alias("good")
    )


def _model_query(name: str, model: str) -> None:
    @query(name, o.sql(_FITTED, _KNOWN))
    def run(spark, sf):
        """The candidate fitted at its full size on all attacks and applied to them."""
        rows = _attacks(spark, sf)
        features = prepared(spark, sf).names
        return _quality(cl.classify(rows, cl.train_model(rows, features, model)))


_model_query("i02_random_forest", "random_forest")
_model_query("i03_boosted", "boosted")
_model_query("i04_boosted_balanced", "boosted_balanced")



@query(
    "i05_class_weights",
    o.sql(
        f"SELECT anomaly_type, count(*) AS n, {o.rd('(SELECT count(*) FROM known) / CAST((SELECT count(DISTINCT anomaly_type) FROM known) * count(*) AS DOUBLE)')} "
        "AS weight FROM known GROUP BY anomaly_type",
        _KNOWN,
    ),
)
def i05(spark, sf):
    return cl.class_weights(cl.training_rows(log(spark, sf))).select("anomaly_type", "n", r("weight"))


_FOLDS = o.sql(
    "SELECT event_id, anomaly_type, CAST((row_number() OVER (PARTITION BY anomaly_type "
    "ORDER BY (event_id * 7919 + 42) % 10007, event_id) - 1) % 5 AS INT) AS fold FROM known",
    _KNOWN,
)


@query("i06_stratified_folds", _FOLDS)
def i06_folds(spark, sf):
    return cl.stratified_folds(cl.training_rows(log(spark, sf))).select("event_id", "anomaly_type", "fold")


@query("i06_stratified_folds_split", _FOLDS)
def i06_folds_split(spark, sf):
    """Every class cut into slices, as a class with a third of the rows is."""
    rows = cl.training_rows(log(spark, sf))
    return cl.stratified_folds(rows, rows_per_slice=8).select("event_id", "anomaly_type", "fold")


def _comparison(spark, sf):
    return shared(
        spark, sf, "comparison",
        lambda: cl.compare_models(_attacks(spark, sf)),
    )


@query(
    "i06_compare_models",
    "SELECT model, CAST(5 AS INT) AS folds, true AS scored, true AS mean_is_of_folds, CAST(NULL AS VARCHAR) AS error, CAST(1 AS BIGINT) AS n_best "
    "FROM (SELECT unnest(['random_forest', 'boosted', 'boosted_balanced']) AS model)",
)
def i06(spark, sf):
    """Five folds of three candidates, grown together at full size: all scored, the best has the largest mean."""
    c = _comparison(spark, sf)
    top = c.agg(F.max("mean_f1")).scalar()
    best = c.agg(F.count_if(F.col("best") & (F.col("mean_f1") == top))).scalar()
    mean = F.aggregate("fold_scores", F.lit(0.0), lambda a, x: a + x) / F.size("fold_scores")
    return c.select(
        "model",
        F.size("fold_scores").alias("folds"),
        F.forall("fold_scores", lambda x: (x >= 0) & (x <= 1)).alias("scored"),
        (F.abs(mean - F.col("mean_f1")) < 1e-9).alias("mean_is_of_folds"),
        "error",
        best.alias("n_best"),
    )


@query("i07_best_model", o.sql(_FITTED, _KNOWN))
def i07(spark, sf):
    """The winner of the comparison, refitted on all attacks and applied to them."""
    rows = _attacks(spark, sf)
    features = prepared(spark, sf).names
    return _quality(cl.classify(rows, cl.train_model(rows, features, cl.best_model(_comparison(spark, sf)))))


_SAID = f"said AS (SELECT event_id, anomaly_type AS truth, {o.RULE_CLASS} AS predicted FROM known)"
_REPORT = """
classes AS (SELECT truth AS class FROM said UNION SELECT predicted FROM said),
per AS (
  SELECT class,
    (SELECT count(*) FROM said WHERE truth = class) AS support,
    CAST((SELECT count(*) FROM said WHERE truth = class AND predicted = class) AS DOUBLE) AS tp,
    CAST((SELECT count(*) FROM said WHERE predicted = class) AS DOUBLE) AS called
  FROM classes),
per2 AS (
  SELECT class, support, tp, CASE WHEN called = 0 THEN 0 ELSE tp / called END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall FROM per),
per3 AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1_score
  FROM per2),
report AS (
  SELECT class, precision, recall, f1_score, support FROM per3 UNION ALL
  SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM per3 UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM per3 UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per3)"""


def _said(spark, sf):
    return cl.training_rows(log(spark, sf)).select(
        "event_id", F.col("anomaly_type").alias("truth"), rule_class().alias("predicted")
    )


@query(
    "i08_classification_report",
    o.sql(
        f"SELECT class, {o.rdas('precision')}, {o.rdas('recall')}, {o.rdas('f1_score')}, support FROM report",
        _KNOWN, _SAID, _REPORT,
    ),
)
def i08(spark, sf):
    out = metrics.classification_report(metrics.confusion(_said(spark, sf), "truth", "predicted"))
    return out.select("class", r("precision"), r("recall"), r("f1_score"), "support")


@query(
    "i09_confusion_matrix",
    o.sql(
        "SELECT truth, "
        + ", ".join(f"count(*) FILTER (WHERE predicted = '{c}') AS \"{c}\"" for c in cfg.ATTACK_TYPES)
        + " FROM said GROUP BY truth",
        _KNOWN, _SAID,
    ),
)
def i09(spark, sf):
    return metrics.confusion_matrix(_said(spark, sf), "truth", "predicted", cfg.ATTACK_TYPES)


_RANKS = "SELECT CAST(rank AS INT) AS rank, true AS in_order, true AS a_share FROM (SELECT unnest(range(1, 16)) AS rank)"


def _ranked_shares(table):
    """Rank, and whether importances fall and are shares of one."""
    order = Window.orderBy(F.desc("importance"), "feature")  # the top few rows only
    out = table.withColumn("rank", F.row_number().over(order))
    falls = F.coalesce(F.lag("importance").over(order) >= F.col("importance"), F.lit(True))
    share = (F.col("importance") >= 0) & (F.sum("importance").over(order.rowsBetween(Window.unboundedPreceding, 0)) <= 1.001)
    return out.select("rank", falls.alias("in_order"), share.alias("a_share"))


@query("i10_top_importances", _RANKS)
def i10(spark, sf):
    return _ranked_shares(cl.top_importances(cl.importances(batch(spark, sf).fitted.classifier, spark)))


@query(
    "i11_flagged_classes",
    o.sql("SELECT count(*) AS n, true AS some_flagged, CAST(0 AS BIGINT) AS flagged_without_class, CAST(0 AS BIGINT) AS classed_without_flag FROM access_log"),
)
def i11(spark, sf):
    """Every flagged event has an attack class, no other one has."""
    b = batch(spark, sf)
    scored = forest.score_forest(_vectors(spark, sf), b.fitted.forest)
    flagged, normal = F.col("prediction") == -1, F.col("attack") == "Normal"
    return cl.classify_flagged(scored, b.fitted.classifier).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(flagged) > 0).alias("some_flagged"),
        F.count_if(flagged & normal).alias("flagged_without_class"),
        F.count_if(~flagged & ~normal).alias("classed_without_flag"),
    )


# --- attributions --------------------------------------------------------------


@query("l01_attributions", "SELECT true AS some_flagged, CAST(0 AS BIGINT) AS unexplained")
def l01(spark, sf):
    """Attributions of all flagged events by the full model add up to its output."""
    b = batch(spark, sf)
    model = b.fitted.classifier
    flagged = b.scored.where(F.col("prediction") == -1).select("event_id", "attack")
    rows = explain.attribute(_vectors(spark, sf).join(flagged, "event_id"), model)
    start = F.array(*[F.lit(v) for v in explain.expected_output(model, spark)])
    code = cl.encode_class("attack", list(model.classes)).cast("int")
    total = F.aggregate("shap", F.lit(0.0), lambda acc, x: acc + x)
    gap = cl.outputs(F.col("features"), model)[code] - start[code] - total
    return rows.agg(
        (F.count(F.lit(1)) > 0).alias("some_flagged"), F.count_if(F.abs(gap) > 1e-6).alias("unexplained")
    )


# A boosted model of two known trees: class 0 by failed_attempts and geo_velocity_kmph, class 1 by bytes_uploaded.
_LITERAL_MODEL = [
    (0, 0, 0, 0, 0, 3.5, 1, 2, 100.0, 1.0, [0.0]), (0, 0, 0, 1, 1, 500.0, 3, 4, 80.0, 1.0, [0.0]),
    (0, 0, 0, 2, -1, 0.0, -1, -1, 20.0, 0.0, [2.0]), (0, 0, 0, 3, -1, 0.0, -1, -1, 60.0, 0.0, [-1.0]),
    (0, 0, 0, 4, -1, 0.0, -1, -1, 20.0, 0.0, [0.5]),
    (0, 0, 1, 0, 2, 2000.0, 1, 2, 100.0, 3.0, [0.0]), (0, 0, 1, 1, -1, 0.0, -1, -1, 75.0, 0.0, [-0.5]),
    (0, 0, 1, 2, -1, 0.0, -1, -1, 25.0, 0.0, [1.5]),
]


def _literal_model(spark):
    nodes = spark.createDataFrame(_LITERAL_MODEL, NODES)
    return cl.Classifier("literal", nodes, True, ("Brute Force", "Low-and-Slow Exfiltration"), tuple(_LITERAL))


def _literal_rows(spark, sf):
    kind = F.when(F.col("event_id") % 2 == 0, "Brute Force").otherwise("Low-and-Slow Exfiltration")
    return log(spark, sf).select(
        "event_id", kind.alias("attack"), F.array(*[F.col(c).cast("double") for c in _LITERAL]).alias("features")
    )


# The first tree's value of a known set of features: v(both), v(failed only), v(geo only), v(none).
_V = {
    "fg": "CASE WHEN failed_attempts > 3.5 THEN 2.0 WHEN geo_velocity_kmph <= 500 THEN -1.0 ELSE 0.5 END",
    "f": "CASE WHEN failed_attempts > 3.5 THEN 2.0 ELSE 0.75 * -1.0 + 0.25 * 0.5 END",
    "g": "0.2 * 2.0 + 0.8 * (CASE WHEN geo_velocity_kmph <= 500 THEN -1.0 ELSE 0.5 END)",
    "n": "0.2 * 2.0 + 0.6 * -1.0 + 0.2 * 0.5",
}


@query(
    "l01_attributions_literal",
    o.sql(
        "SELECT event_id, "
        f"{o.rd('CASE WHEN event_id % 2 = 0 THEN ((fg - g) + (f - n)) / 2 ELSE 0 END')} AS failed_attempts, "
        f"{o.rd('CASE WHEN event_id % 2 = 0 THEN ((fg - f) + (g - n)) / 2 ELSE 0 END')} AS geo_velocity_kmph, "
        f"{o.rd('CASE WHEN event_id % 2 = 0 THEN 0 WHEN bytes_uploaded <= 2000 THEN -0.5 ELSE 1.5 END')} "
        f"- {o.rd('CASE WHEN event_id % 2 = 0 THEN 0 ELSE 0.75 * -0.5 + 0.25 * 1.5 END')} AS bytes_uploaded FROM (SELECT *, "
        + ", ".join(f"CAST({x} AS DOUBLE) AS {n}" for n, x in _V.items())
        + " FROM access_log)"
    ),
)
def l01_literal(spark, sf):
    """Shapley values of two known trees for every event."""
    out = explain.attribute(_literal_rows(spark, sf), _literal_model(spark))
    return out.select("event_id", *[r(F.col("shap")[i]).alias(c) for i, c in enumerate(_LITERAL)])


# A linear score's exact attribution is weight * (value - mean): any SQL engine can check it.
_LINEAR = {
    "failed_attempts": 0.5,
    "geo_velocity_kmph": 0.002,
    "bytes_uploaded": 0.0004,
    "session_duration_zscore": 0.3,
    "login_hour": -0.02,
    "bytes_downloaded": 0.00003,
}


def _linear(spark, sf):
    df = profiled(spark, sf)
    means = df.agg(*[F.avg(c).alias(c) for c in _LINEAR]).first()
    values = F.array(*[F.col(c).cast("double") for c in _LINEAR])
    shap = F.array(*[F.lit(w) * (F.col(c) - F.lit(means[c])) for c, w in _LINEAR.items()])
    return df.where(F.col("label") == "Anomaly").select(
        "event_id", "anomaly_type", "failed_attempts", "geo_velocity_kmph", "bytes_uploaded",
        values.alias("features"), shap.alias("shap"),
    )


_LINEAR_LONG = " UNION ALL ".join(
    f"SELECT event_id, anomaly_type, '{c}' AS feature, CAST({c} AS DOUBLE) AS v, "
    f"CAST({w} AS DOUBLE) * ({c} - (SELECT avg({c}) FROM running)) AS s FROM running WHERE label = 'Anomaly'"
    for c, w in _LINEAR.items()
)
_NAMED = ", ".join(f"('{k}', '{v}')" for k, v in cfg.FEATURE_NAMES.items())
_OWN_NAMES = "CASE feature WHEN 'bytes_uploaded' THEN 'Bytes Uploaded' WHEN 'bytes_downloaded' THEN 'Bytes Downloaded' WHEN 'login_hour' THEN 'Login Hour' END"


def _ranked(k: int) -> str:
    return f"""{o.RUNNING},
longform AS ({_LINEAR_LONG}),
ranked AS (
  SELECT event_id, anomaly_type, feature, coalesce(h, {_OWN_NAMES}) AS human_name, {o.rd('s', 4)} AS shap_value,
    {o.rd('v', 4)} AS feature_value, CASE WHEN s > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction,
    CAST(row_number() OVER (PARTITION BY event_id ORDER BY abs(s) DESC, feature) AS INT) AS rank
  FROM longform LEFT JOIN (VALUES {_NAMED}) AS names(k, h) ON k = feature),
top AS (SELECT * FROM ranked WHERE rank <= {k})"""


_TOP_COLUMNS = "event_id, rank, feature, human_name, shap_value, feature_value, direction"


@query("l02_top_features", o.sql(f"SELECT {_TOP_COLUMNS} FROM top", _ranked(5)))
def l02(spark, sf):
    return explain.long_form(explain.top_features(_linear(spark, sf), list(_LINEAR), 5))


_BY_GAIN = [("bytes_uploaded", 0.6), ("failed_attempts", 0.2), ("geo_velocity_kmph", 0.2)]


@query(
    "l03_fallback_attributions",
    o.sql(
        " UNION ALL ".join(
            f"SELECT event_id, CAST({i + 1} AS INT) AS rank, '{c}' AS feature, CAST({v} AS DOUBLE) AS shap_value, "
            f"round(CAST({c} AS DOUBLE), 4) AS feature_value, 'increases_risk' AS direction FROM access_log"
            for i, (c, v) in enumerate(_BY_GAIN)
        )
    ),
)
def l03(spark, sf):
    """Importances of two known trees in place of attributions."""
    rows = explain.fallback_features(_literal_rows(spark, sf), _literal_model(spark))
    return explain.long_form(rows).drop("human_name")


@query("l03_fallback_fitted", "SELECT CAST(rank AS INT) AS rank, CAST(1 AS BIGINT) AS features, true AS increasing FROM (SELECT unnest(range(1, 6)) AS rank)")
def l03_fitted(spark, sf):
    """Of the fitted model: all flagged events name the same features, always increasing."""
    b = batch(spark, sf)
    flagged = b.scored.where(F.col("prediction") == -1).select("event_id")
    out = explain.long_form(explain.fallback_features(_vectors(spark, sf).join(flagged, "event_id"), b.fitted.classifier))
    return out.groupBy("rank").agg(
        F.count_distinct("feature").alias("features"), F.bool_and(F.col("direction") == "increases_risk").alias("increasing")
    )


@query(
    "l04_narratives",
    o.sql(
        "SELECT event_id, concat('Attack Classification: **', anomaly_type, '**', chr(10), "
        "'Top Behavioral Anomalies & Risk Drivers:', chr(10), string_agg(printf('  %d. **%s** (Value: %s) -> Contribution Score: %+.4f', "
        "rank, human_name, CAST(feature_value AS VARCHAR), shap_value), chr(10) ORDER BY rank)) AS narrative "
        "FROM top GROUP BY event_id, anomaly_type",
        _ranked(3),
    ),
)
def l04(spark, sf):
    rows = explain.top_features(_linear(spark, sf), list(_LINEAR), 3)
    return rows.select("event_id", explain.narrative(F.col("top_features"), F.col("anomaly_type")).alias("narrative"))


@query(
    "l05_analyst_summaries",
    o.sql(
        "SELECT event_id, concat('This event was flagged primarily due to anomalous **', lower(max(human_name) FILTER (WHERE rank = 1)), "
        "'**, combined with unusual **', lower(max(human_name) FILTER (WHERE rank = 2)), '**. The behavioral pattern strongly correlates with a **', "
        "anomaly_type, '** attack and poses a **', risk_level, '** risk to the organization. "
        "Review the detailed SHAP contributions and automated SOAR actions to proceed with mitigation.') AS summary "
        "FROM top JOIN (SELECT event_id, risk_level FROM scored) USING (event_id) GROUP BY event_id, anomaly_type, risk_level",
        _ranked(2), o.SCORED,
    ),
)
def l05(spark, sf):
    rows = explain.top_features(_linear(spark, sf), list(_LINEAR), 2)
    # A level depends on its own row only: those of other rows need no shuffle.
    levels = rule_scored(log(spark, sf).where(F.col("label") == "Anomaly")).select("event_id", "risk_level")
    said = explain.analyst_summary(F.col("top_features"), F.col("anomaly_type"), F.col("risk_level"))
    return rows.join(levels, "event_id").select("event_id", said.alias("summary"))


@query(
    "l06_global_summary",
    o.sql(
        f"SELECT CAST(rank AS INT) AS rank, CAST(least(1000, {_ROWS}) AS BIGINT) AS sample_size, true AS in_order, true AS a_share, true AS named "
        "FROM (SELECT unnest(range(1, 16)) AS rank)"
    ),
)
def l06(spark, sf):
    table = explain.global_summary(batch(spark, sf).fitted.classifier, _vectors(spark, sf))
    about = table.select("rank", F.col("sample_size").cast("long").alias("sample_size"), (F.length("human_name") > 0).alias("named"))
    return about.join(_ranked_shares(table.drop("rank")), "rank")


@query(
    "l07_sample_event",
    o.sql(
        f"SELECT event_id, anomaly_type FROM (SELECT *, {o.RULE_DECISION} AS decision FROM access_log) WHERE decision < 0 "
        "ORDER BY CASE WHEN anomaly_type IN ('Brute Force', 'Device Spoofing') THEN 0 ELSE 1 END, event_id LIMIT 1"
    ),
)
def l07(spark, sf):
    flagged = log(spark, sf).where(rule_decision() < 0)
    return explain.sample_event(flagged, ["Brute Force", "Device Spoofing"])


@query(
    "n10_importance_ranking",
    "SELECT feature, human_name, CAST(importance AS DOUBLE) AS importance FROM (VALUES ('bytes_uploaded', 'Bytes Uploaded', 0.6), "
    "('failed_attempts', '" + cfg.FEATURE_NAMES["failed_attempts"] + "', 0.2), ('geo_velocity_kmph', '"
    + cfg.FEATURE_NAMES["geo_velocity_kmph"] + "', 0.2)) AS t(feature, human_name, importance)",
)
def n10(spark, sf):
    """Ranking of the importances of two known trees; that of the fitted model is i10."""
    return analyst.importance_ranking(cl.importances(_literal_model(spark), spark)).select(
        "feature", sc.human_name(F.col("feature")).alias("human_name"), r("importance")
    )


@query(
    "n21_contribution_table",
    o.sql(
        "SELECT event_id, human_name, shap_value, CASE WHEN shap_value > 0 THEN 'red' ELSE 'green' END AS colour FROM top",
        _ranked(10),
    ),
)
def n21(spark, sf):
    return explain.contribution_table(explain.top_features(_linear(spark, sf), list(_LINEAR), 10))


@query(
    "q_batch_summary",
    o.sql(
        f"SELECT result, n FROM (SELECT 'scored' AS result, {_ROWS} AS n UNION ALL SELECT 'matrix', {_ROWS} UNION ALL "
        f"SELECT 'profiled', {_ROWS} UNION ALL SELECT 'comparison', 3 UNION ALL SELECT 'detection', 1 UNION ALL "
        "SELECT 'report', (SELECT count(DISTINCT anomaly_type) + 3 FROM known) UNION ALL SELECT 'summary', 15 UNION ALL "
        "SELECT 'explanation', 1 UNION ALL SELECT 'winner_fitted', 1 UNION ALL SELECT 'findings_passed', 10)",
        _KNOWN,
    ),
)
def batch_summary(spark, sf):
    """What one complete run leaves behind: rows of every result, the winner of the comparison fitted, checks passed."""
    b = batch(spark, sf)
    names = ["scored", "matrix", "profiled", "comparison", "detection", "report", "summary", "explanation"]
    counts = [(n, getattr(b, n).count()) for n in names]
    counts.append(("winner_fitted", int(cl.best_model(b.comparison) == b.fitted.classifier.name)))
    counts.append(("findings_passed", b.findings.where("severity = 'PASS'").count()))
    return spark.createDataFrame(counts, "result string, n long")
