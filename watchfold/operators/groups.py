"""Statistics of whole groups, joined back to the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchfold.operators.running import ENTITY
from watchfold.operators.slicing import attach
from watchfold.session import keep

PEER_METRICS = {
    "session": "session_duration_min",
    "bytes_up": "bytes_uploaded",
    "bytes_down": "bytes_downloaded",
}


def group_counts(df: DataFrame) -> DataFrame:
    """One pass for all group statistics: (field, key, value, n, peer means).

    Entity rows count each value of the two access fields (missing ones too);
    department rows carry the means.  Values are counted before anything is
    gathered per entity, so a hot entity costs as many rows as it has distinct
    values.
    """
    missing = F.lit(None).cast("string")
    items = []
    if ENTITY in df.columns:
        items = [
            F.struct(F.lit(c).alias("field"), F.col(ENTITY).alias("key"), F.col(c).alias("value"))
            for c in ("resource_accessed", "geo_location")
            if c in df.columns
        ]
    if "department" in df.columns:
        items.append(
            F.struct(F.lit("department").alias("field"), F.col("department").alias("key"), missing.alias("value"))
        )
    peers = {m: c for m, c in PEER_METRICS.items() if c in df.columns}
    long = df.select(F.explode(F.array(*items)).alias("i"), *peers.values()).select("i.*", *peers.values())
    dept = F.col("field") == "department"
    return long.where(F.col("key").isNotNull()).groupBy("field", "key", "value").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.when(dept, F.col(c))).alias(f"peer_avg_{m}") for m, c in peers.items()],
    )


def access_patterns(counts: DataFrame) -> DataFrame:
    """Per entity: entropy of the resources used, distinct resources and places, events."""
    res, geo = F.col("field") == "resource_accessed", F.col("field") == "geo_location"
    known = F.col("value").isNotNull()
    n = F.when(res & known, F.col("n"))
    total = F.sum(n)
    # -sum(p * log2 p) written with plain sums: log2(N) - sum(n * log2 n) / N.
    entropy = F.log2(total) - F.sum(n * F.log2(n)) / total
    return counts.where(res | geo).groupBy(F.col("key").alias(ENTITY)).agg(
        F.greatest(entropy, F.when(total.isNotNull(), F.lit(0.0))).alias("resource_access_entropy"),
        F.count_if(res & known).alias("unique_resources_cumulative"),
        F.count_if(geo & known).alias("unique_locations_cumulative"),
        F.greatest(F.sum(F.when(res, F.col("n"))), F.sum(F.when(geo, F.col("n")))).alias("events"),
    )


def peer_means(counts: DataFrame) -> DataFrame:
    """Department means of session length and transferred bytes."""
    cols = [c for c in counts.columns if c.startswith("peer_avg_")]
    return counts.where(F.col("field") == "department").select(F.col("key").alias("department"), *cols)


def fit_access_patterns(df: DataFrame) -> DataFrame:
    return keep(access_patterns(group_counts(df.drop("department"))), "access-patterns")


def fit_peers(df: DataFrame) -> DataFrame:
    return keep(peer_means(group_counts(df.drop(ENTITY))), "peers")


def attach_access_patterns(df: DataFrame, patterns: DataFrame) -> DataFrame:
    counted = [c for c in patterns.columns if c.startswith("unique_")]
    return attach(df, patterns.drop("events"), [ENTITY]).fillna(0, subset=counted)


def attach_peers(df: DataFrame, peers: DataFrame) -> DataFrame:
    joined = attach(df, peers, ["department"])
    new = {}
    for m, c in PEER_METRICS.items():
        if f"peer_avg_{m}" in peers.columns:
            new[f"peer_{m}_deviation"] = F.col(c) - F.col(f"peer_avg_{m}")
    return joined.withColumns(new)
