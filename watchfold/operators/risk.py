"""Rule-based risk: one projection, every term visible in its own column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.functions import scalars as sc


def weights(raw: dict[str, float] | None = None) -> dict[str, float]:
    """Points per rule, normalised to 100."""
    raw = raw or cfg.RISK_WEIGHTS
    total = float(sum(raw.values())) or 1.0
    return {name: w / total * 100.0 for name, w in raw.items()}


def risk_terms(
    columns: list[str],
    score_col: str = "anomaly_score",
    attack_col: str | None = "attack",
    raw_weights: dict[str, float] | None = None,
) -> dict[str, tuple[Column, Column]]:
    """Rule name -> (points, contributor text or null), in reporting order."""
    w = weights(raw_weights)
    zero = F.lit(0.0)

    def column(name: str, default) -> Column:
        return F.col(name) if name in columns else F.lit(default)

    def text(points: Column, words: Column | str) -> Column:
        words = F.lit(words) if isinstance(words, str) else words
        return F.concat(F.lit("+"), points.cast("int").cast("string"), F.lit(" "), words)

    terms: dict[str, tuple[Column, Column]] = {}

    top = w["anomaly_confidence"]
    pts = F.coalesce(F.col(score_col).cast("double") / 100.0 * F.lit(top), zero)
    word = F.when(pts >= top * 0.5, F.lit("High anomaly confidence")).otherwise(F.lit("Moderate anomaly confidence"))
    terms["anomaly"] = (F.greatest(pts, zero), F.when(pts > 0, text(pts, word)))

    top = w["resource_sensitivity"]
    level = F.lower(F.coalesce(column("resource_sensitivity", "Low"), F.lit("Low")))
    pts = (
        F.when(level == "critical", F.lit(top))
        .when(level == "high", F.lit(top * 0.75))
        .when(level == "medium", F.lit(top * 0.25))
        .otherwise(zero)
    )
    said = F.when(level == "critical", text(pts, "Critical resource")).when(
        level == "high", text(pts, "High sensitivity resource")
    )
    terms["resource"] = (pts, said)

    top = w["privilege_level"]
    level = F.lower(F.coalesce(column("privilege_level", "User"), F.lit("User")))
    pts = (
        F.when(level == "admin", F.lit(top))
        .when(level == "poweruser", F.lit(top * 0.7))
        .when(level == "service", F.lit(top * 0.5))
        .otherwise(zero)
    )
    said = F.when(level == "admin", text(pts, "Admin privilege")).when(
        level == "poweruser", text(pts, "PowerUser privilege")
    )
    terms["privilege"] = (pts, said)

    for name, source, words in (
        ("off_hours", "is_off_hours", "Off-hours login"),
        ("new_device", "new_device", "New device"),
        ("new_location", "new_location", "New location"),
    ):
        on = sc.truthy(column(source, False))
        pts = F.lit(w[name])
        terms[name] = (F.when(on, pts).otherwise(zero), F.when(on, text(pts, words)))

    fails = F.coalesce(column("failed_attempts", 0).cast("double"), zero)
    pts = F.when(fails > 0, F.least(fails / 5.0, F.lit(1.0)) * F.lit(w["failed_attempts"])).otherwise(zero)
    words = F.concat(F.lit("Multiple failed attempts ("), fails.cast("long").cast("string"), F.lit(")"))
    terms["failures"] = (pts, F.when(fails >= 3, text(pts, words)))

    speed = F.coalesce(column("geo_velocity_kmph", 0).cast("double"), zero)
    fast = speed > cfg.TRAVEL_LIMIT_KMPH
    pts = F.lit(w["geo_velocity"])
    words = F.concat(F.lit("Impossible travel ("), speed.cast("long").cast("string"), F.lit(" km/h)"))
    terms["travel"] = (F.when(fast, pts).otherwise(zero), F.when(fast, text(pts, words)))

    if attack_col is not None:
        attack = F.col(attack_col)
        on = F.coalesce(attack != "Normal", F.lit(False))
        pts = F.lit(cfg.ATTACK_BUMP)
        words = F.concat(F.lit("Suspected "), attack, F.lit(" attack pattern"))
        terms["attack"] = (F.when(on, pts).otherwise(zero), F.when(on, text(pts, words)))
    return terms


def risk_level(score: Column) -> Column:
    ladder = F
    for name, limit in cfg.RISK_LEVEL_LIMITS:
        ladder = ladder.when(score <= limit, F.lit(name))
    return ladder.otherwise(F.lit(cfg.RISK_TOP_LEVEL))


def score_risk(
    df: DataFrame,
    score_col: str = "anomaly_score",
    attack_col: str | None = "attack",
    raw_weights: dict[str, float] | None = None,
) -> DataFrame:
    """Add risk_score, risk_level and risk_contributors."""
    terms = risk_terms(df.columns, score_col, attack_col, raw_weights)
    total = sum((pts for pts, _ in terms.values()), F.lit(0.0))
    score = F.least(F.greatest(total, F.lit(0.0)), F.lit(100.0))
    said = F.concat_ws(" | ", *[words for _, words in terms.values()])
    scored = df.withColumns({"risk_score": score, "risk_contributors": said})
    return scored.withColumn("risk_level", risk_level(F.col("risk_score")))


def level_histogram(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))
