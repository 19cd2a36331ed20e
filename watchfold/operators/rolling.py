"""Look-back features of each entity: the last days, and entropy up to each event.

A sliding window is the difference of two running sums, at a probe behind the events
of the same time and at one placed where the window begins: events of one time count
each other.  Running sums can be sliced, so a hot
entity spreads over many tasks, which a RANGE window cannot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.operators.running import ENTITY
from watchfold.operators.slicing import fit_slices, running_sums

DAY = 86_400_000_000
_ORDER = ["_at", "_kind", "event_id", "_sub"]
_PROBE, _EVENT, _READ, _EXPIRY = 0, 1, 2, 3


def _placed(df: DataFrame, at: Column, kind: int, sub: int = 1, **values: Column) -> DataFrame:
    return df.select(
        ENTITY, "event_id", at.alias("_at"), F.lit(kind).alias("_kind"), F.lit(sub).alias("_sub"),
        *[x.cast("double").alias(n) for n, x in values.items()],
    )


def _summed(rows: DataFrame, names: list[str], rows_per_slice: int) -> DataFrame:
    slices = fit_slices(rows, [ENTITY], F.col("_at") * 4 + F.col("_kind"), rows_per_slice, tie=F.col("event_id"))
    return running_sums(rows, [ENTITY], _ORDER, {f"_r_{n}": F.col(n) for n in names}, slices)


def rolling_rates(df: DataFrame, days: int, rows_per_slice: int = cfg.ROWS_PER_SLICE) -> DataFrame:
    """Logins and the shares of failures, new devices and new places in the last days."""
    flags = {
        "n": F.lit(1),
        "failed": sc.is_failed(),
        "device": F.col("new_device").cast("int"),
        "place": F.col("new_location").cast("int"),
    }
    nothing = {n: F.lit(0) for n in flags}
    rows = _placed(df, sc.micros(), _EVENT, **flags).unionByName(
        _placed(df, sc.micros() - F.lit(days * DAY), _PROBE, **nothing)
    ).unionByName(_placed(df, sc.micros(), _READ, **nothing))
    summed = _summed(rows, list(flags), rows_per_slice).where(F.col("_kind") != _EVENT)
    sign = F.when(F.col("_kind") == _READ, 1).otherwise(-1)
    inside = summed.groupBy("event_id").agg(*[F.sum(sign * F.col(f"_r_{n}")).alias(n) for n in flags])
    return inside.select(
        "event_id",
        F.col("n").cast("long").alias(f"login_frequency_{days}d"),
        (F.col("failed") / F.col("n")).alias(f"failed_login_ratio_{days}d"),
        (F.col("device") / F.col("n")).alias(f"new_device_rate_{days}d"),
        (F.col("place") / F.col("n")).alias(f"new_location_rate_{days}d"),
    )


def _numbered(df: DataFrame, column: str, rows_per_slice: int) -> DataFrame:
    """Each event's place among the entity's events with the same value."""
    rows = df.where(F.col(column).isNotNull()).select(ENTITY, "event_id", column, sc.micros().alias("_at"))
    slices = fit_slices(rows, [ENTITY, column], F.col("_at"), rows_per_slice, tie=F.col("event_id"))
    return running_sums(rows, [ENTITY, column], ["_at", "event_id"], {"_k": F.lit(1)}, slices)


def rolling_distinct(
    df: DataFrame, column: str, name: str, days: int, rows_per_slice: int = cfg.ROWS_PER_SLICE
) -> DataFrame:
    """Distinct values in the last days.

    An event counts from its time until the value occurs again or the window has
    passed, whichever is first: one +1 and one -1 per event, then a running sum.
    """
    this = _numbered(df, column, rows_per_slice)
    following = this.select(
        ENTITY, column, (F.col("_k") - 1).alias("_k"), F.col("_at").alias("_next"), F.col("event_id").alias("_next_id")
    )
    pairs = this.join(following, [ENTITY, column, "_k"], "left")  # unique keys
    again = F.coalesce(F.col("_next") - F.col("_at") <= days * DAY, F.lit(False))
    ends = pairs.select(
        ENTITY,
        F.when(again, F.col("_next_id")).otherwise(F.col("event_id")).alias("event_id"),
        F.when(again, F.col("_next")).otherwise(F.col("_at") + days * DAY).alias("_at"),
        F.when(again, _EVENT).otherwise(_EXPIRY).alias("_kind"),
        F.lit(0).alias("_sub"),
        F.lit(-1.0).alias("n"),
    )
    counted = F.col(column).isNotNull().cast("int")
    rows = _placed(df, sc.micros(), _EVENT, n=counted).unionByName(ends)
    rows = rows.unionByName(_placed(df, sc.micros(), _READ, n=F.lit(0)))
    summed = _summed(rows, ["n"], rows_per_slice)
    return summed.where(F.col("_kind") == _READ).select("event_id", F.col("_r_n").cast("long").alias(name))


def expanding_entropy(df: DataFrame, rows_per_slice: int = cfg.ROWS_PER_SLICE) -> DataFrame:
    """Entropy of the resources used so far, without knowledge of the future.

    The k-th use of a resource adds k*log2(k) - (k-1)*log2(k-1) to sum(n*log2 n).
    """
    used = _numbered(df, "resource_accessed", rows_per_slice)
    k = F.col("_k").cast("double")
    gain = k * F.log2(k) - F.when(k > 1, (k - 1) * F.log2(k - 1)).otherwise(0.0)
    rows = used.select(ENTITY, "event_id", "_at", F.lit(_EVENT).alias("_kind"), F.lit(1).alias("_sub"),
                       gain.alias("gain"), F.lit(1.0).alias("n"))
    read = used.select(ENTITY, "event_id", "_at", F.lit(_READ).alias("_kind"), F.lit(1).alias("_sub"),
                       F.lit(0.0).alias("gain"), F.lit(0.0).alias("n"))
    summed = _summed(rows.unionByName(read), ["gain", "n"], rows_per_slice).where(F.col("_kind") == _READ)
    entropy = F.log2("_r_n") - F.col("_r_gain") / F.col("_r_n")
    return summed.select("event_id", F.greatest(entropy, F.lit(0.0)).alias("resource_access_entropy_to_date"))
