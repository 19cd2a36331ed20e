"""Running behaviour of each entity, in time order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.operators.slicing import SLICE, Slices, fit_slices, null_safe_join, quantiles
from watchfold.session import keep

ENTITY = "entity_id"
ORDER = ["event_ts", "event_id"]
# metric -> columns whose running count, mean and spread are kept
METRICS = {
    "session": "session_duration_min",
    "bytes_up": "bytes_uploaded",
    "bytes_down": "bytes_downloaded",
}
# rate -> column whose running share of true / failed rows is kept
RATES = {
    "entity_failed_rate": "login_status",
    "new_device_rate": "new_device",
    "new_location_rate": "new_location",
}


def fit_entity_slices(
    df: DataFrame, rows_per_slice: int = cfg.ROWS_PER_SLICE, at_most: int | None = None
) -> Slices | None:
    return fit_slices(df, [ENTITY], sc.micros(), rows_per_slice, at_most, F.col("event_id"))


def running_features(
    df: DataFrame, slices: Slices | None = None, median_gap: float | None = None
) -> DataFrame:
    """Gap to the previous event, running means, spreads, z-scores, rates, streak.

    All windows share one partitioning and one order, so the rows are shuffled and
    sorted once.  ``slices`` spreads hot entities over many tasks.  The first gap
    of an entity is ``median_gap``, or missing when that is not given.
    """
    state = _with_state(df, slices)
    metrics, rates = _inputs(df)
    new: dict[str, Column] = {"entity_login_count": F.col("_n").cast("long")}
    gap = sc.minutes_between(F.col("_prev"), F.col("event_ts"))
    new["time_since_last_login_min"] = (
        gap if median_gap is None else F.coalesce(gap, F.lit(float(median_gap)))
    )
    for m in metrics:
        new[f"entity_avg_{m}"] = F.try_divide(F.col(f"_sum_{m}"), F.col(f"_cnt_{m}"))
    stds = {
        m: F.when(F.col(f"_cnt_{m}") > 1, F.sqrt(F.col(f"_m2_{m}") / (F.col(f"_cnt_{m}") - 1)))
        for m in metrics
    }
    if "session" in metrics:
        new["entity_std_session"] = F.coalesce(stds["session"], F.lit(0.0))
    zscores = {"session": "session_duration_zscore", "bytes_up": "bytes_uploaded_zscore",
               "bytes_down": "bytes_downloaded_zscore"}
    for m in metrics:
        away = F.col(METRICS[m]) - new[f"entity_avg_{m}"]
        new[zscores[m]] = sc.clip(away / sc.nonzero_std(stds[m]))
    if "login_status" in df.columns:
        new["consecutive_failures"] = (F.col("_n") - F.coalesce(F.col("_last_ok"), F.lit(0))).cast("long")
    for name in rates:
        new[name] = F.try_divide(F.col(f"_sum_{name}"), F.col(f"_cnt_{name}"))
    return state.withColumns(new).select(*df.columns, *new)


def fit_median_gap(
    df: DataFrame,
    slices: Slices | None = None,
    approx: bool = False,
    rows_per_slice: int = cfg.ROWS_PER_SLICE,
    rows: int | None = None,
) -> float | None:
    """Median of all gaps between successive events of an entity, in minutes."""
    gaps = running_features(df.select(ENTITY, *ORDER), slices)
    names = {"median_gap": 0.5}
    bound = df.count() if rows is None else rows
    row = quantiles(gaps, [], "time_since_last_login_min", names, approx, rows_per_slice, bound).first()
    return row["median_gap"] if row else None


def _inputs(df: DataFrame) -> tuple[list[str], dict[str, Column]]:
    metrics = [m for m, c in METRICS.items() if c in df.columns]
    rates = {
        n: sc.is_failed(c) if c == "login_status" else F.col(c).cast("int")
        for n, c in RATES.items()
        if c in df.columns
    }
    return metrics, rates


def _with_state(df: DataFrame, slices: Slices | None) -> DataFrame:
    if slices is None:
        return _local_state(df, [ENTITY])
    cut = slices.assign(df)
    local = _local_state(cut, [ENTITY, SLICE])
    before = keep(_state_before(_local_state(slices.only_large(cut), [ENTITY, SLICE]), df), "running")
    both = null_safe_join(local, before, [ENTITY, SLICE])
    return _merge(both, df).drop(SLICE)


def _local_state(df: DataFrame, part: list[str]) -> DataFrame:
    """Running state inside one window partition."""
    order = Window.partitionBy(*part).orderBy(*ORDER)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    metrics, rates = _inputs(df)
    cols: dict[str, Column] = {
        "_n": F.row_number().over(order).cast("long"),
        "_prev": F.lag("event_ts").over(order),
    }
    for m in metrics:
        x = F.col(METRICS[m])
        cols[f"_cnt_{m}"] = F.count(x).over(upto)
        cols[f"_sum_{m}"] = F.sum(x).over(upto).cast("double")
        cols[f"_m2_{m}"] = F.var_pop(x).over(upto) * F.count(x).over(upto)
        if SLICE in part:
            cols[f"_min_{m}"] = F.min(x).over(upto)
            cols[f"_max_{m}"] = F.max(x).over(upto)
    for name, flag in rates.items():
        cols[f"_cnt_{name}"] = F.count(flag).over(upto)
        cols[f"_sum_{name}"] = F.sum(flag).over(upto)
    out = df.withColumns(cols)
    if "login_status" in df.columns:
        # The streak is the distance to the last row that did not fail.
        ok_at = F.when(sc.is_failed() == 0, F.col("_n"))
        out = out.withColumn("_last_ok", F.max(ok_at).over(upto))
    return out


def _state_before(local: DataFrame, df: DataFrame) -> DataFrame:
    """State of each large entity just before each of its slices."""
    metrics, rates = _inputs(df)
    state = [c for c in local.columns if c.startswith("_") and c not in ("_prev", SLICE)]
    ends = (
        local.groupBy(ENTITY, SLICE)
        .agg(F.max_by(F.struct("event_ts", *state), F.col("_n")).alias("_end"))
        .select(ENTITY, SLICE, F.col("_end.event_ts").alias("_ts"), *[f"_end.{c}" for c in state])
    )
    order = Window.partitionBy(ENTITY).orderBy(SLICE)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    centred = ends
    for m in metrics:
        mean = F.try_divide(F.col(f"_sum_{m}"), F.col(f"_cnt_{m}"))
        centred = centred.withColumn(f"_mean_{m}", mean)
        shift = F.first(f"_mean_{m}", ignorenulls=True).over(whole)
        centred = centred.withColumn(f"_d_{m}", F.col(f"_mean_{m}") - shift)
    cols: dict[str, Column] = {
        "_b_n": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
        "_b_ts": F.max("_ts").over(earlier),
    }
    for m in metrics:
        n, d = F.col(f"_cnt_{m}"), F.col(f"_d_{m}")
        cols[f"_b_cnt_{m}"] = F.sum(n).over(earlier)
        cols[f"_b_sum_{m}"] = F.sum(f"_sum_{m}").over(earlier)
        spread = F.sum(F.col(f"_m2_{m}") + n * d * d).over(earlier)
        offset = F.sum(n * d).over(earlier)
        cols[f"_b_m2_{m}"] = spread - F.try_divide(offset * offset, F.sum(n).over(earlier))
        cols[f"_b_min_{m}"] = F.min(f"_min_{m}").over(earlier)
        cols[f"_b_max_{m}"] = F.max(f"_max_{m}").over(earlier)
    for name in rates:
        cols[f"_b_cnt_{name}"] = F.sum(f"_cnt_{name}").over(earlier)
        cols[f"_b_sum_{name}"] = F.sum(f"_sum_{name}").over(earlier)
    out = centred.withColumns(cols)
    if "_last_ok" in state:
        ok_at = F.col("_b_n") + F.col("_last_ok")
        out = out.withColumn("_b_last_ok", F.max(ok_at).over(earlier))
    return out.select(ENTITY, SLICE, *[c for c in out.columns if c.startswith("_b_")])


def _merge(both: DataFrame, df: DataFrame) -> DataFrame:
    """Combine the state inside the slice with the state before it."""
    metrics, rates = _inputs(df)
    zero = F.lit(0)
    before_n = F.coalesce(F.col("_b_n"), zero)
    cols: dict[str, Column] = {
        "_n": F.col("_n") + before_n,
        "_prev": F.coalesce(F.col("_prev"), F.col("_b_ts")),
    }
    for m in metrics:
        na, nb = F.coalesce(F.col(f"_b_cnt_{m}"), zero), F.col(f"_cnt_{m}")
        sa, sb = F.coalesce(F.col(f"_b_sum_{m}"), F.lit(0.0)), F.coalesce(F.col(f"_sum_{m}"), F.lit(0.0))
        gap = F.try_divide(sb, nb) - F.try_divide(sa, na)
        between = F.coalesce(gap * gap * na * nb / F.nullif(na + nb, zero), F.lit(0.0))
        m2 = F.coalesce(F.col(f"_b_m2_{m}"), F.lit(0.0)) + F.coalesce(F.col(f"_m2_{m}"), F.lit(0.0)) + between
        low = F.least(F.col(f"_b_min_{m}"), F.col(f"_min_{m}"))
        high = F.greatest(F.col(f"_b_max_{m}"), F.col(f"_max_{m}"))
        cols[f"_cnt_{m}"] = na + nb
        cols[f"_sum_{m}"] = sa + sb
        cols[f"_m2_{m}"] = F.when(low == high, F.lit(0.0)).otherwise(F.greatest(m2, F.lit(0.0)))
    for name in rates:
        for part in ("_cnt_", "_sum_"):
            cols[part + name] = F.coalesce(F.col(part + name), zero) + F.coalesce(F.col(f"_b{part}{name}"), zero)
    if "login_status" in df.columns:
        cols["_last_ok"] = F.coalesce(F.col("_last_ok") + before_n, F.col("_b_last_ok"))
    merged = both.withColumns(cols)
    return merged.drop(*[c for c in merged.columns if c.startswith("_b_")])
