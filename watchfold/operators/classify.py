"""Attack classification with tree ensembles that are grown and cross-validated in joint Spark jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators.slicing import fit_slices, running_sums
from watchfold.operators.sparse import Rows, lists
from watchfold.operators.trees import APART, BLOCK, Ensemble, Plan, ensemble_of, fit_trees
from watchfold.session import keep


def training_rows(vectors: DataFrame) -> DataFrame:
    """Known attacks only; the anomaly model's opinion plays no part."""
    return vectors.where((F.col("label") == "Anomaly") & (F.col("anomaly_type") != "Normal"))


def class_weights(rows: DataFrame, column: str = "anomaly_type") -> DataFrame:
    """Balanced weights: n / (classes * n of the class)."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    total = whole.select(F.col("n") / F.col("k")).scalar()
    return counts.select(column, "n", (total / F.col("n")).alias("weight"))


def class_names(rows: DataFrame, column: str = "anomaly_type") -> list[str]:
    """Sorted attack types; their positions are the codes."""
    return [r[0] for r in rows.select(column).distinct().orderBy(column).collect()]


def encode_class(column: str, classes: list[str]) -> Column:
    return (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(column)) - 1).cast("double")


def decode_class(column: str, classes: list[str]) -> Column:
    return F.array(*[F.lit(c) for c in classes])[F.col(column).cast("int")]


def stratified_folds(
    rows: DataFrame,
    folds: int = cfg.CV_FOLDS,
    seed: int = cfg.FOREST_SEED,
    column: str = "anomaly_type",
    rows_per_slice: int = cfg.ROWS_PER_SLICE,
) -> DataFrame:
    """Deal the rows of each class to the folds in a shuffled, repeatable order."""
    mixed = rows.withColumn("_mix", (F.col("event_id") * 7919 + F.lit(seed)) % 10007)
    slices = fit_slices(mixed, [column], F.col("_mix"), rows_per_slice, tie=F.col("event_id"))
    nth = running_sums(mixed, [column], ["_mix", "event_id"], {"_nth": F.lit(1)}, slices)
    return nth.withColumn("fold", ((F.col("_nth") - 1) % folds).cast("int")).drop("_mix", "_nth")


@dataclass(frozen=True)
class Effort:
    """Sizes of the candidate models; the defaults are the full settings."""

    trees: int = cfg.RANDOM_FOREST["trees"]
    tree_depth: int = cfg.RANDOM_FOREST["depth"]
    rounds: int = cfg.BOOSTED["rounds"]
    max_depth: int | None = None


def candidates(effort: Effort = Effort()) -> dict[str, Callable[[], Plan]]:
    """Model name -> how it is grown, in order of preference for ties."""

    def boosted(settings: dict, balanced: bool) -> Plan:
        depth = min(settings["depth"], effort.max_depth or settings["depth"])
        return Plan(
            boosted=True, trees=effort.rounds, depth=depth, balanced=balanced, rate=settings["rate"],
            rows=settings["subsample"], columns=settings["columns"], least_weight=settings["least_weight"],
            least_rows=settings["least_rows"], shrink=settings["shrink"], leaves=settings["leaves"],
        )

    return {
        "random_forest": lambda: Plan(boosted=False, trees=effort.trees, depth=effort.tree_depth, balanced=True),
        "boosted": lambda: boosted(cfg.BOOSTED, balanced=False),
        "boosted_balanced": lambda: boosted(cfg.BOOSTED_BALANCED, balanced=True),
    }


def learnable(rows: DataFrame, classes: list[str]) -> DataFrame:
    """Rows with class code and fold (0 where none was dealt)."""
    fold = F.col("fold") if "fold" in rows.columns else F.lit(0)
    return rows.select("event_id", "features", encode_class("anomaly_type", classes).alias("class_code"), fold.alias("fold"))


def _fit(rows: DataFrame, plans: list[tuple[str, Plan]], classes: int, seed: int) -> tuple[list[DataFrame | None], list[str | None]]:
    """Node tables of the plans, those of a kind grown together, the kinds side by side; failures as text, found plan by plan."""
    nodes: list[DataFrame | None] = [None] * len(plans)
    errors: list[str | None] = [None] * len(plans)
    kinds = sorted({(p.boosted, p.trees if p.boosted else 0) for _, p in plans}, reverse=True)

    def fit(kind: tuple[bool, int]) -> None:
        mine = [i for i, (_, p) in enumerate(plans) if (p.boosted, p.trees if p.boosted else 0) == kind]
        groups = [mine]
        while groups:
            group = groups.pop()
            try:
                table = fit_trees(rows, [plans[i][1] for i in group], classes, seed)
                for m, i in enumerate(group):
                    nodes[i] = table.where(F.col("member") == m)
            except Exception as failure:  # noqa: BLE001 - reported beside the others
                names = sorted({plans[i][0] for i in group})
                if len(names) > 1:
                    groups += [[i for i in group if plans[i][0] == name] for name in names]
                else:
                    for i in group:
                        errors[i] = str(failure)[:500]

    # Jobs of two kinds fill the slots that the last long tasks of either leave free.
    with ThreadPoolExecutor(max(1, len(kinds))) as pool:
        list(pool.map(fit, kinds))
    return nodes, errors


def macro_f1(counts: dict[tuple[int, int], int]) -> float:
    """Mean F1 of the classes that occur as truth or as answer, from counts per (truth, answer)."""
    scores = []
    for c in {k for pair in counts for k in pair}:
        hit = counts.get((c, c), 0)
        said = sum(n for (_, p), n in counts.items() if p == c)
        true = sum(n for (t, _), n in counts.items() if t == c)
        scores.append(2 * hit / (said + true))
    return sum(scores) / len(scores) if scores else 0.0


def compare_models(
    rows: DataFrame,
    effort: Effort = Effort(),
    folds: int = cfg.CV_FOLDS,
    seed: int = cfg.FOREST_SEED,
    names: list[str] | None = None,
) -> DataFrame:
    """Cross-validated macro F1 per candidate: (model, mean_f1, std_f1, fold_scores, error, best).

    All folds of all candidates of a kind grow in the same jobs; then one pass gives
    every row the answer of the members that did not see it. ``names`` chooses
    candidates. One that fails is reported, not fatal; on equal means the earlier wins.
    """
    spark: SparkSession = rows.sparkSession
    classes = class_names(rows)
    # The window leaves a small table in one part; the models are tried on all slots.
    parts = max(spark.sparkContext.defaultParallelism, -(-rows.count() // BLOCK))
    dealt = keep(learnable(stratified_folds(rows, folds, seed), classes).repartition(parts, "event_id"), "folds")
    wanted = {n: make for n, make in candidates(effort).items() if names is None or n in names}
    plans: list[tuple[str, Plan]] = []
    failed: dict[str, str] = {}
    for name, make in wanted.items():
        try:
            plan = make()
            plans += [(name, Plan(**{**plan.__dict__, "held_out": k})) for k in range(folds)]
        except Exception as failure:  # noqa: BLE001 - reported in the table
            failed[name] = str(failure)[:500]
    nodes, errors = _fit(dealt, plans, len(classes), seed)
    failed |= {name: error for (name, _), error in zip(plans, errors, strict=True) if error}
    wanted_nodes = [
        (name, plan, table) for (name, plan), table in zip(plans, nodes, strict=True) if name not in failed and table is not None
    ]
    # The models are bounded by their settings; the small jobs that fetch them share the slots.
    with ThreadPoolExecutor(8) as pool:
        made = pool.map(lambda m: (m[0], m[1].held_out, ensemble_of(m[2], m[1].boosted, len(classes))), wanted_nodes)
        members = list(made)
    grown = [n for n in wanted if n not in failed]
    counts = _answers(dealt, members, grown)
    out = []
    for place, name in enumerate(wanted):
        if name in failed:
            out.append((place, name, None, None, None, failed[name]))
            continue
        scores = [macro_f1(counts.get((name, k), {})) for k in range(folds)]
        mean = sum(scores) / folds
        std = (sum((s - mean) ** 2 for s in scores) / folds) ** 0.5
        out.append((place, name, mean, std, scores, None))
    best = max((r for r in out if r[2] is not None), key=lambda r: (r[2], -r[0]), default=None)
    table = [(*r[1:], best is not None and r[0] == best[0]) for r in out]
    return spark.createDataFrame(
        table, "model string, mean_f1 double, std_f1 double, fold_scores array<double>, error string, best boolean"
    )


def _answers(dealt: DataFrame, members: list[tuple[str, int, Ensemble]], names: list[str]) -> dict:
    """(model, fold) -> counts per (truth, answer) of the rows that the fold's member did not see."""
    if not members:
        return {}
    shared = dealt.sparkSession.sparkContext.broadcast(members)

    @F.arrow_udf("array<int>")
    def answer(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for features, fold in batches:
            rows, fold = Rows.of(features), fold.to_numpy(zero_copy_only=False)
            out = np.zeros((len(fold), len(names)), np.int32)
            for name, k, model in shared.value:
                mine = np.flatnonzero(fold == k)
                if len(mine):
                    out[mine, names.index(name)] = model.outputs(rows.take(mine)).argmax(axis=1)
            yield lists(out, np.ones(len(out), bool))

    said = dealt.select("fold", F.col("class_code").cast("int").alias("truth"), F.posexplode(answer("features", "fold")).alias("m", "said"))
    out: dict = {}
    # At most candidates * folds * classes^2 rows.
    for r in said.groupBy("m", "fold", "truth", "said").count().collect():
        out.setdefault((names[r["m"]], r["fold"]), {})[r["truth"], r["said"]] = r["count"]
    return out


def best_model(comparison: DataFrame) -> str | None:
    row = comparison.where("best").first()
    return row["model"] if row else None


@dataclass(frozen=True)
class Classifier:
    """A fitted model (its node table) with the class order and feature order it was fitted on."""

    name: str
    nodes: DataFrame
    boosted: bool
    classes: tuple[str, ...]
    features: tuple[str, ...]
    _sent: dict = field(default_factory=dict, compare=False, repr=False)

    def save(self, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.nodes.sparkSession.createDataFrame(
            [(self.name, self.boosted, list(self.classes), list(self.features))],
            "name string, boosted boolean, classes array<string>, features array<string>",
        ).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Classifier":
        m = spark.read.parquet(f"{path}/meta").first()
        nodes = spark.read.parquet(f"{path}/nodes")
        return Classifier(m["name"], nodes, m["boosted"], tuple(m["classes"]), tuple(m["features"]))

    def sent(self, name: str, make: Callable[["Classifier"], object]) -> Broadcast:
        """Something made of the node table (whose size the settings bound), sent to the workers once."""
        if name not in self._sent:
            self._sent[name] = self.nodes.sparkSession.sparkContext.broadcast(make(self))
        return self._sent[name]

    def ensemble(self) -> Broadcast:
        return self.sent("ensemble", lambda c: ensemble_of(c.nodes, c.boosted, len(c.classes)))


def grown_apart(rows: DataFrame) -> bool:
    """Whether a model of these rows is grown by tasks of its own instead of jobs per level."""
    return rows.count() <= APART * BLOCK


def train_model(
    rows: DataFrame, features: list[str], name: str, effort: Effort = Effort(), seed: int = cfg.FOREST_SEED
) -> Classifier:
    """Fit one candidate on all known attacks."""
    classes = class_names(rows)
    plan = candidates(effort)[name]()
    nodes = fit_trees(learnable(rows.drop("fold"), classes), [plan], len(classes), seed)
    return Classifier(name, nodes, plan.boosted, tuple(classes), tuple(features))


def outputs(features: Column, classifier: Classifier) -> Column:
    """Per class: margins of a boosted model, mean shares of a forest; null features give null."""
    model = classifier.ensemble()

    @F.arrow_udf("array<double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            known = column.is_valid().to_numpy(zero_copy_only=False)
            yield lists(model.value.outputs(Rows.of(column.filter(pa.array(known)))), known)

    return score(features)


def probabilities(outputs: Column, classifier: Classifier) -> Column:
    if not classifier.boosted:
        return outputs
    powers = F.transform(outputs, lambda z: F.exp(z - F.array_max(outputs)))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _winner(outputs: Column, classifier: Classifier) -> Column:
    names = F.array(*[F.lit(c) for c in classifier.classes])
    return names[F.array_position(outputs, F.array_max(outputs)).cast("int") - 1]


def classify(vectors: DataFrame, classifier: Classifier) -> DataFrame:
    """Add ``attack``, the decoded class of every row."""
    out = vectors.withColumn("_outputs", outputs(F.col("features"), classifier))
    return out.withColumn("attack", _winner(F.col("_outputs"), classifier)).drop("_outputs")


def classify_flagged(scored: DataFrame, classifier: Classifier) -> DataFrame:
    """Attack class of flagged events; everything else is Normal, and its features are not sent to the model."""
    flagged = F.col("prediction") == -1
    out = scored.withColumn("_outputs", outputs(F.when(flagged, F.col("features")), classifier))
    attack = F.when(F.col("_outputs").isNotNull(), _winner(F.col("_outputs"), classifier)).otherwise("Normal")
    return out.withColumn("attack", attack).drop("_outputs")


def importances(classifier: Classifier, spark: SparkSession) -> DataFrame:
    """(feature, importance): each feature's share of the gain of all splits; one row per feature."""
    gains = classifier.nodes.where("feature >= 0").groupBy("feature").agg(F.sum("gain").alias("gain"))
    # One row per feature of the model.
    table = {r["feature"]: r["gain"] for r in gains.collect()}
    total = sum(table.values()) or 1.0
    rows = [(f, float(table.get(i, 0.0) / total)) for i, f in enumerate(classifier.features)]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_importances(table: DataFrame, k: int = cfg.TOP_IMPORTANCES) -> DataFrame:
    return (
        table.orderBy(F.desc("importance"), "feature")
        .limit(k)
        .select("feature", F.round("importance", 4).alias("importance"))
    )
