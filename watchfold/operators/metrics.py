"""Quality of detections and classifications, from counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators.slicing import fit_slices, running_sums
from watchfold.session import keep



def ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, truth: Column, flagged: Column) -> DataFrame:
    """Confusion counts, precision, recall, F1 and false-positive rate."""
    counts = df.agg(
        F.count_if(truth & flagged).alias("tp"),
        F.count_if(~truth & flagged).alias("fp"),
        F.count_if(truth & ~flagged).alias("fn"),
        F.count_if(~truth & ~flagged).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp", "fp", "fn", "tn",
        F.round(ratio(tp, tp + fp), 4).alias("precision"),
        F.round(ratio(tp, tp + fn), 4).alias("recall"),
        F.round(ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
        F.round(ratio(fp, fp + tn), 4).alias("fpr"),
    )


def _by_score(df: DataFrame, truth: Column, score: str) -> DataFrame:
    return df.groupBy(F.lit(0).alias("_all"), F.col(score).cast("double").alias("_score")).agg(
        F.count_if(truth).alias("pos"), F.count_if(~truth).alias("neg")
    )


def roc_auc(df: DataFrame, truth: Column, score: str, rows_per_slice: int = cfg.ROWS_PER_SLICE) -> DataFrame:
    """Exact area under the ROC curve; 0.0 when only one class occurs.

    Counted per distinct score, then the negatives below each score are a running
    sum, so neither a global sort into one task nor pairs of rows are needed.
    """
    counts = keep(_by_score(df, truth, score), "score-counts")
    slices = fit_slices(counts, ["_all"], F.col("_score"), rows_per_slice)
    upto = running_sums(counts, ["_all"], ["_score"], {"_negs": F.col("neg")}, slices)
    won = F.col("pos") * (F.col("_negs") - F.col("neg") / 2.0)
    return upto.agg(F.sum(won).alias("_w"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n")).select(
        ratio(F.col("_w"), F.col("_p").cast("double") * F.col("_n")).alias("roc_auc")
    )


def top_share_recall(
    df: DataFrame,
    truth: Column,
    score: str,
    share: float = cfg.ALERT_BUDGET,
    rows_per_slice: int = cfg.ROWS_PER_SLICE,
) -> DataFrame:
    """Share of the true anomalies among the top ``share`` of the scores.

    Ties go to the smaller event_id.  The scores are cut where the running count
    reaches the budget.
    """
    rows, positives = df.agg(F.count(F.lit(1)), F.count_if(truth)).first()
    budget = int(share * rows)
    marked = df.select("event_id", F.col(score).cast("double").alias("_score"), truth.alias("_true"))
    if budget == 0 or positives == 0:
        found = df.sparkSession.range(1).select(F.lit(0).cast("long").alias("found"))
    else:
        found = _found_in_budget(marked, budget, rows_per_slice)
    return found.select(
        F.lit(budget).alias("budget"),
        "found",
        ratio(F.col("found"), F.lit(positives)).alias("recall"),
    )


def _found_in_budget(marked: DataFrame, budget: int, rows_per_slice: int) -> DataFrame:
    counts = keep(_by_score(marked, F.col("_true"), "_score"), "score-counts")
    down = -F.col("_score")
    slices = fit_slices(counts, ["_all"], down, rows_per_slice)
    size = F.col("pos") + F.col("neg")
    upto = running_sums(counts, ["_all"], [down], {"_upto": size}, slices)
    inside = upto.where(F.col("_upto") <= budget).agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("found"))
    edge = upto.where((F.col("_upto") > budget) & (F.col("_upto") - size < budget)).first()
    if edge is None:
        return inside
    wanted = budget - (edge["_upto"] - edge["pos"] - edge["neg"])
    ties = marked.where(F.col("_score") == F.lit(edge["_score"])).withColumn("_all", F.lit(0))
    tie_slices = fit_slices(ties, ["_all"], F.col("event_id"), rows_per_slice)
    nth = running_sums(ties, ["_all"], ["event_id"], {"_nth": F.lit(1)}, tie_slices)
    extra = nth.where(F.col("_nth") <= wanted).agg(F.count_if("_true").alias("found"))
    return inside.unionAll(extra).agg(F.sum("found").alias("found"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts per pair of true and predicted class, both as text."""
    return df.groupBy(
        F.col(truth).cast("string").alias("truth"), F.col(predicted).cast("string").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, truth: str, predicted: str, classes: list[str]) -> DataFrame:
    """One row per true class, one column per predicted class."""
    return df.groupBy(F.col(truth).alias("truth")).pivot(predicted, classes).count().fillna(0)


def classification_report(counts: DataFrame) -> DataFrame:
    """Per class and averaged precision, recall, F1 and support from ``confusion``."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    by_truth = counts.groupBy(F.col("truth").alias("class")).agg(F.sum("n").alias("support"), F.sum(hit).alias("_tp"))
    by_pred = counts.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("_said"))
    zero = F.lit(0)
    per = by_truth.join(by_pred, "class", "full").select(
        "class",
        F.coalesce("support", zero).alias("support"),
        F.coalesce("_tp", zero).alias("_tp"),
        ratio(F.coalesce("_tp", zero), F.coalesce("_said", zero)).alias("precision"),
        ratio(F.coalesce("_tp", zero), F.coalesce("support", zero)).alias("recall"),
    )
    per = per.withColumn(
        "f1_score",
        ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )
    scores = ["precision", "recall", "f1_score"]
    total = F.sum("support").alias("support")
    hits = F.sum("_tp") / F.sum("support")
    rows = [
        per.select("class", *scores, "support"),
        per.agg(*[hits.alias(s) for s in scores], total).select(F.lit("accuracy").alias("class"), *scores, "support"),
        per.agg(*[F.avg(s).alias(s) for s in scores], total).select(F.lit("macro avg").alias("class"), *scores, "support"),
        per.agg(*[(F.sum(F.col(s) * F.col("support")) / F.sum("support")).alias(s) for s in scores], total).select(
            F.lit("weighted avg").alias("class"), *scores, "support"
        ),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def macro_f1(counts: DataFrame) -> float:
    row = classification_report(counts).where(F.col("class") == "macro avg").first()
    return float(row["f1_score"]) if row and row["f1_score"] is not None else 0.0
