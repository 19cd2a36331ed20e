"""Normal-behaviour profiles of entities and departments, and deviations from them.

The value sets of a profile (places, devices, resources, ...) are kept as rows of
a long table instead of arrays: a department may know millions of devices.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.operators.slicing import attach, quantiles
from watchfold.session import keep

# profile set -> source column
SETS = {
    "geo_locations": "geo_location",
    "devices": "device_fingerprint",
    "resources": "resource_accessed",
    "protocols": "protocol",
    "auth_methods": "auth_method",
}
MODES = {
    "login_hour_mode": "login_hour",
    "geo_location_mode": "geo_location",
    "resource_mode": "resource_accessed",
    "privilege_mode": "privilege_level",
}
SPREADS = {
    "login_hour": "login_hour",
    "session": "session_duration_min",
    "bytes_up": "bytes_uploaded",
    "bytes_down": "bytes_downloaded",
}
FIELDS = [
    "event_count", "login_hour_mean", "login_hour_std", "login_hour_mode",
    "geo_location_mode", "resource_mode", "privilege_mode",
    "session_mean", "session_std", "session_median",
    "bytes_up_mean", "bytes_up_std", "bytes_down_mean", "bytes_down_std", "failed_ratio",
    *[f"n_{s}" for s in SETS],
]
DEVIATIONS = {
    "profile_hour_deviation": ("login_hour", "login_hour"),
    "profile_session_deviation": ("session_duration_min", "session"),
    "profile_bytes_up_deviation": ("bytes_uploaded", "bytes_up"),
}
NOVELTIES = {
    "profile_new_geo": ("geo_location", "geo_locations"),
    "profile_new_resource": ("resource_accessed", "resources"),
    "profile_new_device": ("device_fingerprint", "devices"),
}


@dataclass(frozen=True)
class Profiles:
    entity: DataFrame  # one row per entity
    department: DataFrame  # one row per department
    values: DataFrame  # (owner, field, value, n): the value sets of both

    def save(self, path: str) -> None:
        for name in ("entity", "department", "values"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Profiles":
        return Profiles(*[spark.read.parquet(f"{path}/{n}") for n in ("entity", "department", "values")])


def _owner(key: str, value: Column) -> Column:
    return F.concat(F.lit(f"{key}:"), value)


def count_values(df: DataFrame, key: str) -> DataFrame:
    """Every distinct value of the profiled fields per key, with its count."""
    fields = sorted(set(SETS.values()) | set(MODES.values()))
    items = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields if c in df.columns]
    )
    long = df.where(F.col(key).isNotNull()).select(key, F.explode(items).alias("i")).select(key, "i.*")
    return long.where(F.col("value").isNotNull()).groupBy(key, "field", "value").agg(F.count(F.lit(1)).alias("n"))


def build_profiles(df: DataFrame, key: str, counted: DataFrame, rows_per_slice: int = cfg.ROWS_PER_SLICE) -> DataFrame:
    """Scalar profile per key; ``counted`` is the output of ``count_values``."""
    known = df.where(F.col(key).isNotNull())
    stats = [F.count(F.lit(1)).alias("event_count"), F.avg(sc.is_failed()).alias("failed_ratio")]
    for name, c in SPREADS.items():
        stats += [F.avg(c).alias(f"{name}_mean"), F.stddev_pop(c).alias(f"{name}_std")]
    if key != "department":
        first = F.min_by("department", F.struct("event_ts", "event_id"))
        stats.append(first.alias("first_department"))
    base = known.groupBy(key).agg(*stats)
    median = quantiles(known, [key], "session_duration_min", {"session_median": 0.5}, rows_per_slice=rows_per_slice)

    picks = []
    for name, c in MODES.items():
        ranked = F.col("value").cast("int") if c == "login_hour" else F.col("value")
        best = F.min_by(
            F.when(F.col("field") == c, F.col("value")),
            F.when(F.col("field") == c, F.struct(-F.col("n"), ranked)),
        )
        picks.append(best.cast("int").alias(name) if c == "login_hour" else F.coalesce(best, F.lit("Unknown")).alias(name))
    picks += [F.count_if(F.col("field") == c).alias(f"n_{s}") for s, c in SETS.items()]
    modes = counted.groupBy(key).agg(*picks)
    out = base.join(median, key, "left").join(modes, key, "left")
    return out.select(key, *FIELDS, *[c for c in out.columns if c == "first_department"])


def fit_profiles(
    df: DataFrame,
    min_events: int = cfg.MIN_PROFILE_EVENTS,
    rows_per_slice: int = cfg.ROWS_PER_SLICE,
) -> Profiles:
    """Profiles of departments and entities; new entities borrow their department's."""
    by_dept = keep(count_values(df, "department"), "dept-values")
    by_entity = keep(count_values(df, "entity_id"), "entity-values")
    dept = keep(build_profiles(df, "department", by_dept, rows_per_slice), "dept-profiles")
    own = build_profiles(df, "entity_id", by_entity, rows_per_slice)
    peer = dept.select(
        F.col("department").alias("first_department"),
        F.lit(True).alias("_known"),
        *[F.col(f).alias(f"_d_{f}") for f in FIELDS],
    )
    joined = attach(own, peer, ["first_department"])
    cold = F.col("event_count") < min_events
    borrow = cold & F.coalesce(F.col("_known"), F.lit(False))
    entity = joined.select(
        "entity_id",
        *[F.when(borrow, F.col(f"_d_{f}")).otherwise(F.col(f)).alias(f) for f in FIELDS],
        cold.alias("cold_start"),
        F.when(borrow, F.col("first_department")).alias("fallback_department"),
    )
    values = by_entity.select(_owner("entity", F.col("entity_id")).alias("owner"), "field", "value", "n").unionByName(
        by_dept.select(_owner("department", F.col("department")).alias("owner"), "field", "value", "n")
    )
    return Profiles(keep(entity, "entity-profiles"), dept, values)


def profile_sets(profiles: Profiles) -> DataFrame:
    """The value sets as rows (owner, set name, value)."""
    names = F.create_map(*[F.lit(x) for s, c in SETS.items() for x in (c, s)])
    in_sets = profiles.values.where(F.col("field").isin(*SETS.values()))
    return in_sets.select("owner", names[F.col("field")].alias("set_name"), "value")


def _unknown_values(rows: DataFrame, profiles: Profiles) -> DataFrame:
    """(owner, field, value) of the rows that no profile knows.

    These are few where the rows are like those the profiles were fitted on, however many
    values are known; and only distinct values are shuffled to find them.
    """
    items = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c, _ in NOVELTIES.values()])
    own = rows.where("_profiled").select(F.col("_owner").alias("owner"), F.explode(items).alias("i")).select("owner", "i.*")
    keys = ["owner", "field", "value"]
    return keep(own.where(F.col("value").isNotNull()).distinct().join(profiles.values, keys, "left_anti"), "unknown-values")


def apply_profiles(df: DataFrame, profiles: Profiles, events: DataFrame | None = None) -> DataFrame:
    """Add the three deviations and the three novelty flags.

    An entity without a profile gets 0 throughout; a missing value of a profiled
    entity counts as new. The rows of a table are joined with the values no profile knows,
    those of a stream with the known ones. ``events`` may name the table whose rows ``df``
    has, if ``df`` is costly to read twice.
    """
    cols = ["entity_id", "fallback_department", *{f"{p}_{s}" for _, p in DEVIATIONS.values() for s in ("mean", "std")}]
    prof = profiles.entity.select(
        F.lit(True).alias("_profiled"), "entity_id", *[F.col(c).alias(f"_p_{c}") for c in cols[1:]]
    )

    def owned(rows: DataFrame) -> DataFrame:
        out = attach(rows, prof, ["entity_id"])
        owner = F.coalesce(_owner("department", F.col("_p_fallback_department")), _owner("entity", F.col("entity_id")))
        return out.withColumn("_owner", owner)

    out = owned(df)
    new: dict[str, Column] = {}
    for name, (source, p) in DEVIATIONS.items():
        away = F.abs(F.col(source) - F.col(f"_p_{p}_mean")) / sc.nonzero_std(F.col(f"_p_{p}_std"))
        new[name] = F.coalesce(away, F.lit(0.0))
    profiled = F.coalesce(F.col("_profiled"), F.lit(False))
    seen = _unknown_values(out if events is None else owned(events), profiles) if not df.isStreaming else profiles.values
    for name, (source, _) in NOVELTIES.items():
        listed = seen.where(F.col("field") == source).select(
            F.col("owner").alias("_owner"), F.col("value").alias(source), F.lit(True).alias(f"_k_{source}")
        )
        out = attach(out, listed, ["_owner", source])
        found = F.coalesce(F.col(f"_k_{source}"), F.lit(False))
        fresh = ~found if df.isStreaming else found | F.col(source).isNull()
        new[name] = (profiled & fresh).cast("int")
    return out.withColumns(new).select(*df.columns, *new)
