"""The batch job: from access events to scored events and stored artifacts."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators import classify as cl
from watchfold.operators import drift, encoding, enrich, explain, forest, metrics, profiles, quality, respond, risk
from watchfold.session import keep


@dataclass(frozen=True)
class Fitted:
    """Everything a scorer needs."""

    context: enrich.Context
    profiles: profiles.Profiles
    encoder: encoding.Encoder
    forest: forest.Forest
    classifier: cl.Classifier

    def save(self, path: str) -> None:
        self.context.patterns.write.mode("overwrite").parquet(f"{path}/patterns")
        self.context.peers.write.mode("overwrite").parquet(f"{path}/peers")
        spark = self.context.peers.sparkSession
        spark.createDataFrame([(self.context.median_gap,)], "median_gap double").write.mode("overwrite").parquet(
            f"{path}/context"
        )
        for name in ("profiles", "encoder", "forest", "classifier"):
            getattr(self, name).save(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Fitted":
        gap = spark.read.parquet(f"{path}/context").first()["median_gap"]
        context = enrich.Context(
            gap, spark.read.parquet(f"{path}/patterns"), spark.read.parquet(f"{path}/peers"), None
        )
        return Fitted(
            context,
            profiles.Profiles.load(spark, f"{path}/profiles"),
            encoding.Encoder.load(spark, f"{path}/encoder"),
            forest.Forest.load(spark, f"{path}/forest"),
            cl.Classifier.load(spark, f"{path}/classifier"),
        )


@dataclass(frozen=True)
class Prepared:
    """The first half of a run, which needs no model: features, profiles and the model matrix."""

    context: enrich.Context
    profiles: profiles.Profiles
    encoder: encoding.Encoder
    profiled: DataFrame
    encoded: DataFrame  # profiled + features
    matrix: DataFrame
    names: list[str]


@dataclass(frozen=True)
class Batch:
    """Results of one run, each a written table keyed by event_id."""

    profiled: DataFrame  # input + 27 features + 6 deviations
    matrix: DataFrame  # model matrix: event_id, entity_id, features as (index, value) pairs, targets
    scored: DataFrame  # profiled + prediction, anomaly_score, attack, risk, actions
    reference: DataFrame  # drift baseline
    fitted: Fitted
    findings: DataFrame  # data quality of the input
    detection: DataFrame  # one row: confusion counts, precision, recall, f1, fpr, roc_auc, top_recall
    comparison: DataFrame | None  # cross-validated candidates; None where the model was named
    report: DataFrame  # the classifier on its training rows
    summary: DataFrame  # strongest features
    explanation: DataFrame  # one flagged event with its top features and narrative
    prepared: Prepared


def detection_metrics(scored: DataFrame) -> DataFrame:
    """How the flags and scores agree with the labels, in one row."""
    truth = F.col("label") == "Anomaly"
    out = metrics.binary_metrics(scored, truth, F.col("prediction") == -1)
    auc = metrics.roc_auc(scored, truth, "anomaly_score").select("roc_auc").scalar()
    top = metrics.top_share_recall(scored, truth, "anomaly_score").select("recall").scalar()
    return out.withColumns({"roc_auc": auc, "top_recall": top})


def explain_sample(scored: DataFrame, vectors: DataFrame, classifier: cl.Classifier, k: int = 5) -> DataFrame:
    """A flagged event of a known class, its ``k`` strongest features and the narrative."""
    flagged = scored.where(F.col("prediction") == -1)
    one = explain.sample_event(flagged, cfg.SAMPLE_CLASSES).select("event_id")
    rows = vectors.select("event_id", "features").join(F.broadcast(one), "event_id")
    rows = rows.join(flagged.select("event_id", "attack"), "event_id")
    told = explain.top_of(explain.attribute(rows, classifier), classifier, k)
    return told.select(
        "event_id", "attack", "top_features", explain.narrative(F.col("top_features"), F.col("attack")).alias("narrative")
    )


def prepare(events: DataFrame, rows_per_slice: int = cfg.ROWS_PER_SLICE) -> Prepared:
    """Enrich, profile and encode."""
    context = enrich.fit_context(events, rows_per_slice=rows_per_slice)
    enriched = keep(enrich.enrich(events, context), "enriched")
    profs = profiles.fit_profiles(enriched, rows_per_slice=rows_per_slice)
    profiled = keep(profiles.apply_profiles(enriched, profs), "profiled")
    encoder = encoding.fit_encoder(profiled)
    names = encoding.feature_list(encoder, profiled.columns)
    # Encoded once; from here on every step is a narrow map over the profiled rows.
    encoded = keep(encoding.encode_beside(profiled, encoder), "encoded")
    matrix = encoded.select("event_id", "entity_id", "features", *encoding.TARGETS)
    return Prepared(context, profs, encoder, profiled, encoded, matrix, names)


def run_batch(
    events: DataFrame,
    trees: int = cfg.FOREST_TREES,
    model: str | None = None,
    effort: cl.Effort = cl.Effort(),
    attack_col: str = "attack",
    rows_per_slice: int = cfg.ROWS_PER_SLICE,
    as_of: Column | None = None,
    prepared: Prepared | None = None,
) -> Batch:
    """Check, enrich, profile, encode, detect, compare, classify, score, respond, measure and explain.

    ``attack_col`` chooses the attack type that feeds the risk score: the
    predicted one (default) or the recorded ``anomaly_type``. Without a ``model`` the
    candidates are compared by cross-validation and the best is fitted on all attacks.
    Events after ``as_of`` (default: now) are reported as future ones. ``prepared`` is
    what ``prepare`` has made of the same events, if that was done before.
    """
    as_of = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
    # Parts that do not need each other share the slots: most of their jobs are too short to fill them.
    with ThreadPoolExecutor(max_workers=9) as pool:

        def begin(make: Callable[[], object]) -> Future:
            return pool.submit(inheritable_thread_target(events.sparkSession)(make))

        findings = begin(lambda: keep(quality.findings(events, as_of), "findings"))
        p = prepared or prepare(events, rows_per_slice)
        matrix, names, encoded = p.matrix, p.names, p.encoded

        def isolate() -> tuple[forest.Forest, DataFrame]:
            trained = forest.fit_forest(matrix, names, trees=trees)
            isolated = keep(forest.isolation(encoded, trained), "isolated")
            return forest.calibrate(trained, isolated, rows_per_slice=rows_per_slice), isolated

        isolating = begin(isolate)
        attacks = keep(cl.training_rows(matrix), "attacks")
        comparison = None
        growing: dict[str, Future] = {}
        if model is None:
            if cl.grown_apart(attacks):
                # A candidate on few rows is one long task (or a few): begun early, it fills a slot that the folds leave free.
                growing = {n: begin(lambda n=n: cl.train_model(attacks, names, n, effort)) for n in cl.candidates(effort)}
            comparison = keep(cl.compare_models(attacks, effort), "comparison")
            model = cl.best_model(comparison) or "random_forest"
        classifier = growing[model].result() if model in growing else cl.train_model(attacks, names, model, effort)
        said = cl.classify(attacks, classifier)
        report = begin(lambda: keep(metrics.classification_report(metrics.confusion(said, "anomaly_type", "attack")), "report"))
        summary = begin(lambda: keep(explain.global_summary(classifier, matrix), "summary"))
        trained, isolated = isolating.result()
        fitted = Fitted(p.context, p.profiles, p.encoder, trained, classifier)
        decided = cl.classify_flagged(forest.score_forest(isolated, trained), classifier).drop("features", "isolation")
        scored = respond.recommend(risk.score_risk(decided, attack_col=attack_col), attack_col=attack_col)
        scored = keep(scored.withColumn("is_anomaly", (F.col("prediction") == -1).cast("int")), "scored")
        reference = begin(lambda: keep(drift.fit_reference(drift.split_by_time(scored)[0]), "drift-reference"))
        sample = begin(lambda: keep(explain_sample(scored, matrix, classifier), "explanation"))
        detection = keep(detection_metrics(scored), "detection")
        findings, reference, report, summary, sample = (f.result() for f in (findings, reference, report, summary, sample))
    return Batch(p.profiled, matrix, scored, reference, fitted, findings, detection, comparison, report, summary, sample, p)


