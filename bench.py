"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from watchfold.operators import classify as cl  # noqa: E402
from watchfold.operators import drift, enrich, explain, forest, metrics, profiles, quality, risk, rolling, running  # noqa: E402
from watchfold.plans import analyst  # noqa: E402
from watchfold.plans.registry import rule_score, rule_scored  # noqa: E402
from watchfold.operators import encoding  # noqa: E402
from watchfold.session import keep, local_session, ship_code  # noqa: E402
from watchfold.sources.access_log import read_access_log  # noqa: E402
from watchfold.sources.tables import clustered  # noqa: E402
from watchfold.streaming import live, running_state  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    ship_code(spark)
    from pyspark.sql import functions as F

    log = lambda: state["log"]
    done = lambda df: df.write.format("noop").mode("overwrite").save()

    state: dict[str, object] = {}
    folder = sf_dir

    def ingest():
        """Derive the 30 input columns and store them clustered."""
        state["log"] = keep(clustered(read_access_log(spark, folder)), "bench-log")

    def feature_engineering():
        """All 27 features for every stored event, nothing fitted beforehand."""
        done(enrich.enrich(log()))

    def enriched_table():
        state["enriched"] = keep(enrich.enrich(log()), "bench-enriched")

    def fit_and_apply_profiles():
        rows = state["enriched"]
        state["profiled"] = keep(profiles.apply_profiles(rows, profiles.fit_profiles(rows)), "bench-profiled")

    def encode():
        rows = state["profiled"]
        encoder = encoding.fit_encoder(rows)
        state["names"] = encoding.feature_list(encoder, rows.columns)
        state["matrix"] = keep(encoding.apply_sparse(rows, encoder), "bench-matrix")

    def isolation_forest():
        vectors, names = state["matrix"], state["names"]
        trees = forest.fit_forest(vectors, names)
        scored = keep(forest.isolation(vectors, trees), "bench-isolated")
        state["scored"] = keep(forest.score_forest(scored, forest.calibrate(trees, scored)), "bench-scored")

    def detection_metrics():
        truth = F.col("label") == "Anomaly"
        metrics.binary_metrics(state["scored"], truth, F.col("prediction") == -1).collect()
        metrics.roc_auc(state["scored"], truth, "anomaly_score").collect()

    def drift_of_late_rows():
        """The first 70 % of the events by time against the rest."""
        early, late = drift.split_by_time(state["profiled"])
        drift.detect_drift(drift.fit_reference(early), late).collect()

    def look_back():
        done(rolling.rolling_rates(log(), 7))
        done(rolling.expanding_entropy(log()))

    def classifier():
        """200 rounds of the balanced boosted model on all attacks."""
        state["attacks"] = keep(cl.training_rows(state["matrix"]), "bench-attacks")
        state["classifier"] = cl.train_model(state["attacks"], state["names"], "boosted_balanced")

    def attribution():
        """Class and attributions of every flagged event."""
        flagged = state["scored"].where("prediction = -1")
        said = cl.classify(flagged, state["classifier"])
        done(explain.top_of(explain.attribute(said, state["classifier"]), state["classifier"]))

    def live_responses():
        """Running state of a stream, in event time, for every event."""
        done(live.drain(running_state.running_stream(live.table_stream(spark, folder), 60.0, "0 seconds")))

    queries = {
        "ingest": ingest,
        "data_quality": lambda: quality.findings(log(), F.lit("2024-02-01").cast("timestamp_ntz")).collect(),
        "running_features": lambda: done(running.running_features(log())),
        "feature_engineering": feature_engineering,
        "enriched_table": enriched_table,
        "profiles": fit_and_apply_profiles,
        "encode": encode,
        "isolation_forest": isolation_forest,
        "detection_metrics": detection_metrics,
        "risk_scoring": lambda: done(risk.score_risk(log().withColumn("anomaly_score", rule_score()), attack_col="anomaly_type")),
        "triage": lambda: analyst.triage(rule_scored(log())).collect(),
        "kpis": lambda: analyst.kpis(rule_scored(log())).collect(),
        "drift": drift_of_late_rows,
        "look_back_features": look_back,
        "classifier": classifier,
        "compare_models": lambda: cl.compare_models(state["attacks"]).collect(),
        "attribution": attribution,
        "live_responses": live_responses,
    }
    def run_all() -> dict[str, float]:
        times = {}
        for name, run in queries.items():
            start = time.time()
            run()
            times[name] = round(time.time() - start, 3)
        return times

    # Warm-up on the smallest tables, so that no query pays for starting the JVM.
    small = str(Path(sf_dir).parent / "sf0.001")
    if Path(small).exists():
        folder = small
        run_all()
    folder = sf_dir
    times = run_all()
    line = {
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
