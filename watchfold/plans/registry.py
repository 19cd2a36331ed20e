"""Named queries with their SQL twins, and tables shared between them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.operators import enrich, profiles
from watchfold.operators import forest as fo
from watchfold.operators import risk
from watchfold.plans.batch import Batch, Prepared, prepare, run_batch
from watchfold.session import keep, ship_code
from watchfold.sources.access_log import read_access_log
from watchfold.sources.tables import clustered

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_code(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r(column: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison, under the same name."""
    c = F.col(column) if isinstance(column, str) else column
    out = F.round(c.cast("double"), digits)
    return out.alias(column) if isinstance(column, str) else out


_shared: dict[tuple[str, str, str], object] = {}


def shared(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Compute a table once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The access log, derived from ``events`` and stored once per session."""
    return shared(spark, sf_dir, "log", lambda: keep(clustered(read_access_log(spark, sf_dir)), "access-log"))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "enriched", lambda: keep(enrich.enrich(log(spark, sf_dir)), "enriched"))


def fitted_profiles(spark: SparkSession, sf_dir: str) -> profiles.Profiles:
    return shared(spark, sf_dir, "profiles", lambda: profiles.fit_profiles(log(spark, sf_dir)))


def deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched rows with profile deviations, not stored.

    Unless a query of the session has stored the enriched rows, they are made on the way:
    they leave their windows dealt by entity, as the profiles join them, so that nothing
    wide is written, read and shuffled again.
    """
    rows = _shared.get((spark.sparkContext.applicationId, sf_dir, "enriched"))
    events = log(spark, sf_dir)
    rows = enrich.enrich(events) if rows is None else rows
    return profiles.apply_profiles(rows, fitted_profiles(spark, sf_dir), events)


def profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        return keep(deviations(spark, sf_dir), "profiled")

    return shared(spark, sf_dir, "profiled", make)


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    """The half of the batch job that fits no model, for queries that use none."""

    def make() -> Prepared:
        done = _shared.get((spark.sparkContext.applicationId, sf_dir, "batch"))
        return done.prepared if done else prepare(log(spark, sf_dir))

    return shared(spark, sf_dir, "prepared", make)


def batch(spark: SparkSession, sf_dir: str) -> Batch:
    def make() -> Batch:
        done = _shared.get((spark.sparkContext.applicationId, sf_dir, "prepared"))
        return run_batch(log(spark, sf_dir), **({"prepared": done} if done else {}))

    return shared(spark, sf_dir, "batch", make)


def rule_score() -> Column:
    """A 0-100 score any SQL engine can compute, in place of the forest's."""
    return F.least(
        F.lit(100.0),
        F.col("failed_attempts") * F.lit(4.0)
        + F.col("geo_velocity_kmph") / F.lit(37.0)
        + F.col("bytes_uploaded") / F.lit(411.0),
    )


def rule_decision() -> Column:
    """Same idea on the forest's decision scale: below 0 is anomalous."""
    return F.lit(0.25) - rule_score() / F.lit(100.0)


def rule_class() -> Column:
    """A class any SQL engine can compute, in place of the classifier's."""
    return (
        F.when(F.col("os") == "Kali Linux", "Device Spoofing")
        .when(F.col("failed_attempts") >= 20, "Brute Force")
        .when(F.col("failed_attempts") == 8, "Credential Stuffing")
        .when(F.col("geo_velocity_kmph") > 2000, "Impossible Travel")
        .when(F.col("bytes_uploaded") > 2000, "Low-and-Slow Exfiltration")
        .when(F.col("resource_sensitivity") == "Critical", "Insider Drift")
        .otherwise("Lateral Movement")
    )


def rule_scored(df: DataFrame) -> DataFrame:
    """Events scored from ``rule_score`` and the recorded attack type."""
    out = df.withColumn("anomaly_score", rule_score()).withColumn("prediction", fo.prediction(rule_decision()))
    out = risk.score_risk(out, attack_col="anomaly_type")
    return out.withColumns(
        {"risk_score": F.round("risk_score", 2), "is_anomaly": (F.col("prediction") == -1).cast("int")}
    )


CUTOFF = "2024-01-21 00:00:00"


def early(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_ts") < F.lit(CUTOFF).cast("timestamp_ntz"))


def late(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_ts") >= F.lit(CUTOFF).cast("timestamp_ntz"))


