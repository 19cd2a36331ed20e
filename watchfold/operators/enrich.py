"""All 27 behaviour features in one call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.operators import groups, running
from watchfold.operators.slicing import Slices
from watchfold.session import keep

FEATURES = [
    "hour_sin", "hour_cos", "is_weekend", "month", "day_of_month",
    "time_since_last_login_min",
    "entity_login_count", "entity_avg_session", "entity_std_session",
    "entity_avg_bytes_up", "entity_avg_bytes_down", "entity_failed_rate",
    "session_duration_zscore", "bytes_uploaded_zscore", "bytes_downloaded_zscore",
    "resource_access_entropy", "unique_resources_cumulative", "unique_locations_cumulative",
    "consecutive_failures", "new_device_rate", "new_location_rate",
    "peer_avg_session", "peer_session_deviation",
    "peer_avg_bytes_up", "peer_bytes_up_deviation",
    "peer_avg_bytes_down", "peer_bytes_down_deviation",
]


@dataclass(frozen=True)
class Context:
    """What the features need to know about the whole table."""

    median_gap: float | None
    patterns: DataFrame
    peers: DataFrame
    slices: Slices | None


def fit_context(df: DataFrame, approx: bool = False, rows_per_slice: int = cfg.ROWS_PER_SLICE) -> Context:
    """Two passes: one counts all groups, one finds the median gap.

    The counts also tell whether an entity is too large for one window partition.
    """
    counts = keep(groups.group_counts(df), "group-counts")
    patterns = keep(groups.access_patterns(counts), "access-patterns")
    rows, largest = patterns.agg(F.sum("events"), F.max("events")).first()
    slices = running.fit_entity_slices(df, rows_per_slice, at_most=largest or 0)
    return Context(
        median_gap=running.fit_median_gap(df, slices, approx, rows_per_slice, rows or 0),
        patterns=patterns,
        peers=keep(groups.peer_means(counts), "peers"),
        slices=slices,
    )


def enrich(df: DataFrame, context: Context | None = None) -> DataFrame:
    """Input columns plus the features, one row per input row."""
    context = context or fit_context(df)
    out = running.running_features(df, context.slices, context.median_gap)
    out = groups.attach_access_patterns(out, context.patterns)
    out = groups.attach_peers(out, context.peers)
    out = sc.calendar(out)
    return out.select(*df.columns, *[f for f in FEATURES if f in out.columns])
