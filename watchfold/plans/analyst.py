"""The analyst's questions over the scored table, as lazy functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators import respond
from watchfold.operators.profiles import Profiles


def scored_view(enriched: DataFrame, risk: DataFrame) -> DataFrame:
    """Enriched events with risk (2 decimals), level, contributors, is_anomaly."""
    cols = risk.select(
        "event_id",
        F.round("risk_score", 2).alias("risk_score"),
        "risk_level",
        "risk_contributors",
        (F.col("prediction") == -1).cast("int").alias("is_anomaly"),
    )
    return enriched.join(cols, "event_id")


def matching(
    scored: DataFrame,
    search: str | None = None,
    entity_type: str = "All",
    department: str = "All",
    attack: str = "All",
    regex: bool = False,
) -> DataFrame:
    """Free-text search in the ids plus the three list filters; 'All' passes."""
    out = scored
    if search:
        ids = (F.col("entity_id"), F.col("event_id").cast("string"))
        if regex:
            hit = [c.rlike(f"(?i){search}") for c in ids]
        else:
            hit = [F.contains(F.lower(c), F.lit(search.lower())) for c in ids]
        out = out.where(F.coalesce(hit[0], F.lit(False)) | F.coalesce(hit[1], F.lit(False)))
    for column, wanted in (("entity_type", entity_type), ("department", department), ("anomaly_type", attack)):
        if wanted != "All":
            out = out.where(F.col(column) == wanted)
    return out


def filter_options(df: DataFrame) -> DataFrame:
    """Values offered by the three list filters; attacks come from anomalies only."""
    attack = F.when(F.col("label") == "Anomaly", F.col("anomaly_type"))
    pairs = F.array(
        F.struct(F.lit("entity_type").alias("filter"), F.col("entity_type").alias("value")),
        F.struct(F.lit("department").alias("filter"), F.col("department").alias("value")),
        F.struct(F.lit("attack_type").alias("filter"), attack.alias("value")),
    )
    values = df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
    return values.orderBy("filter", "value")


def kpis(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("is_anomaly").alias("anomalies"),
        F.count_if(F.col("risk_score") >= cfg.HIGH_RISK).alias("high_risk"),
        F.countDistinct(F.when(F.col("label") == "Anomaly", F.col("anomaly_type"))).alias("attack_classes"),
        F.countDistinct("entity_id").alias("entities"),
    )


def _counted(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def attack_distribution(df: DataFrame) -> DataFrame:
    known = df.where(F.col("label") == "Anomaly")
    return _counted(known, "anomaly_type").orderBy(F.desc("n"), "anomaly_type")


def risk_histogram(scored: DataFrame, bins: int = 50) -> DataFrame:
    number = F.least(F.lit(bins), F.width_bucket("risk_score", F.lit(0.0), F.lit(100.0), F.lit(bins)))
    return scored.groupBy(number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def anomalies_by_department(df: DataFrame) -> DataFrame:
    return _counted(df.where(F.col("label") == "Anomaly"), "department").orderBy("n", "department")


def anomalies_by_hour(df: DataFrame) -> DataFrame:
    return _counted(df.where(F.col("label") == "Anomaly"), "login_hour")


def alerts(scored: DataFrame, min_risk: float = cfg.TRIAGE_MIN_RISK) -> DataFrame:
    return scored.where(F.col("risk_score") >= min_risk)


def triage(scored: DataFrame, min_risk: float = cfg.TRIAGE_MIN_RISK, rows: int = cfg.TRIAGE_ROWS) -> DataFrame:
    """The riskiest alerts first: a top-k, not a full sort."""
    return (
        alerts(scored, min_risk)
        .orderBy(F.desc("risk_score"), "event_id")
        .limit(rows)
        .select(*[c for c in cfg.TRIAGE_COLUMNS if c in scored.columns])
    )


def most_common(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value per column, ties to the smallest.

    Counted per value first, so no buffer holds all values of a column.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    counts = (
        df.select(F.explode(pairs).alias("p"))
        .where(F.col("p.value").isNotNull())
        .groupBy("p.column_name", "p.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("column_name").agg(best.alias("value"), F.max("n").alias("n"))


def top_threats(scored: DataFrame, min_risk: float = cfg.TRIAGE_MIN_RISK) -> DataFrame:
    return most_common(alerts(scored, min_risk), ["entity_id", "resource_accessed", "department"])


def triage_summary(scored: DataFrame, min_risk: float = cfg.TRIAGE_MIN_RISK) -> DataFrame:
    return alerts(scored, min_risk).agg(
        F.count(F.lit(1)).alias("alerts"),
        F.round(F.avg("risk_score"), 1).alias("avg_risk"),
        F.countDistinct("entity_id").alias("entities"),
    )


def entity_card(scored: DataFrame, entity_id: str | None = None) -> DataFrame:
    """Type and department (first row), events and anomalies, per entity."""
    rows = scored if entity_id is None else scored.where(F.col("entity_id") == entity_id)
    first = lambda c: F.min_by(c, F.struct("event_ts", "event_id")).alias(c)
    return rows.groupBy("entity_id").agg(
        first("entity_type"),
        first("department"),
        F.count(F.lit(1)).alias("events"),
        F.sum("is_anomaly").alias("anomalies"),
    )


def entity_timeline(scored: DataFrame, entity_id: str) -> DataFrame:
    return (
        scored.where(F.col("entity_id") == entity_id)
        .orderBy("event_ts", "event_id")
        .select("event_id", "entity_id", "event_ts", "risk_score", "is_anomaly", "anomaly_type", "resource_accessed")
    )


def entity_list(df: DataFrame) -> DataFrame:
    return df.select("entity_id").distinct().orderBy("entity_id")


def entity_vs_department(profiles: Profiles, scored_cards: DataFrame) -> DataFrame:
    """Profile metrics of each entity beside those of its department, long form.

    ``scored_cards`` gives each entity's department, see ``entity_card``.
    """
    metrics = list(cfg.PROFILE_METRICS)
    own = profiles.entity.select("entity_id", *metrics)
    dept = profiles.department.select("department", *[F.col(m).alias(f"_d_{m}") for m in metrics])
    both = own.join(scored_cards.select("entity_id", "department"), "entity_id").join(dept, "department", "left")
    items = [
        F.struct(
            F.lit(label).alias("metric"),
            F.coalesce(F.col(m), F.lit(0.0)).alias("e"),
            F.coalesce(F.col(f"_d_{m}"), F.lit(0.0)).alias("d"),
        )
        for m, label in cfg.PROFILE_METRICS.items()
    ]
    long = both.select("entity_id", "department", F.explode(F.array(*items)).alias("i")).select(
        "entity_id", "department", "i.*"
    )
    off = F.when(F.col("d") != 0, (F.col("e") - F.col("d")) / F.nullif(F.col("d"), F.lit(0.0)) * 100).otherwise(0.0)
    return long.select(
        "entity_id", "department", "metric",
        F.round("e", 2).alias("entity_value"),
        F.round("d", 2).alias("department_value"),
        F.round(off, 1).alias("deviation_pct"),
        (F.col("e") / _radius()).alias("entity_radar"),
        (F.col("d") / _radius()).alias("department_radar"),
    )


def _radius() -> Column:
    return F.greatest(F.abs("e"), F.abs("d"), F.lit(1.0))


def alert_labels(scored: DataFrame, rows: int = cfg.ALERT_ROWS) -> DataFrame:
    """The riskiest anomalies with the text an analyst picks from."""
    label = F.format_string(
        "%d | %s | Risk: %s (%s)",
        F.col("event_id"), F.col("entity_id"), F.col("risk_score").cast("string"),
        F.coalesce("risk_level", F.lit("Unknown")),
    )
    return (
        scored.where(F.col("is_anomaly") == 1)
        .orderBy(F.desc("risk_score"), "event_id")
        .limit(rows)
        .select("event_id", label.alias("label"))
    )


def alert_detail(scored: DataFrame, event_id: int | str | None = None) -> DataFrame:
    """Field and value of an alert, one row per field (all events when no id)."""
    rows = scored if event_id is None else scored.where(F.col("event_id").cast("string") == str(event_id))
    cols = [c for c in cfg.DETAIL_COLUMNS if c in scored.columns]
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
            for i, c in enumerate(cols, 1)
        ]
    )
    return rows.select("event_id", F.explode(pairs).alias("p")).select("event_id", "p.*")


def alert_actions(scored: DataFrame) -> DataFrame:
    """Playbook actions of each alert; a missing attack type counts as Normal."""
    return respond.work_list(respond.recommend(scored))


def importance_ranking(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature")
