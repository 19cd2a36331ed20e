"""Distribution drift of the tracked features (two-sample KS test)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.operators.running import ORDER
from watchfold.operators.slicing import Slices, attach, fit_slices, quantiles, running_sums
from watchfold.session import keep

_KS_TERMS = 100


def _long(df: DataFrame, features: list[str]) -> DataFrame:
    present = [f for f in features if f in df.columns]
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in present])
    long = df.select(F.explode(pairs).alias("p")).select("p.*")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def fit_reference(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Counted distribution of each feature: (feature, value, n, total).

    Values are rounded; ``total`` is the sum of the unrounded values behind a row,
    so that the mean of the reference stays exact.
    """
    long = _long(df, features or cfg.DRIFT_FEATURES)
    rounded = F.round("value", cfg.DRIFT_DECIMALS).alias("value")
    return long.groupBy("feature", rounded).agg(
        F.count(F.lit(1)).alias("n"), F.sum(long["value"]).alias("total")
    )


def split_by_time(df: DataFrame, share: float = cfg.DRIFT_REFERENCE_SHARE) -> tuple[DataFrame, DataFrame]:
    """Earlier ``share`` of the events by time, and the rest."""
    timed = df.withColumn("_us", sc.micros())
    cut = quantiles(timed, [], "_us", {"cut": share}).first()["cut"]
    early = sc.micros() < F.lit(cut)
    return df.where(early), df.where(~early)


def split_by_entity_order(
    df: DataFrame, share: float = cfg.DRIFT_REFERENCE_SHARE, rows_per_slice: int = cfg.ROWS_PER_SLICE
) -> DataFrame:
    """Mark the first ``share`` of the rows in (entity, time) order as reference.

    Rank = events of smaller entities + own running number, so no global sort and
    no window over all rows is needed.
    """
    slices = fit_slices(df, ["entity_id"], sc.micros(), rows_per_slice, tie=F.col("event_id"))
    numbered = running_sums(df, ["entity_id"], ORDER, {"_nth": F.lit(1).cast("long")}, slices)
    sizes = df.groupBy("entity_id").agg(F.count(F.lit(1)).alias("_size"))
    before = keep(_rows_before(sizes), "rows-before")
    total = df.count()
    ranked = attach(numbered, before, ["entity_id"])
    position = F.col("_before") + F.col("_nth") - 1
    return ranked.withColumn("is_reference", position < int(total * share)).drop("_nth", "_before")


def _rows_before(sizes: DataFrame) -> DataFrame:
    """Events of all entities that sort before each entity.

    The entities are range-sorted once and written with ids that grow with the
    order; only the totals of the sorted parts are summed over everything.
    """
    ordered = keep(
        sizes.orderBy("entity_id").withColumn("_pos", F.monotonically_increasing_id()), "entities-in-order"
    ).withColumn("_part", F.shiftright("_pos", 33)).withColumn("_all", F.lit(0))
    parts = ordered.groupBy("_all", "_part").agg(F.sum("_size").alias("_psize"))
    starts = running_sums(parts, ["_all"], ["_part"], {"_upto": F.col("_psize")}).select(
        "_part", (F.col("_upto") - F.col("_psize")).alias("_start")
    )
    inside = running_sums(ordered, ["_part"], ["_pos"], {"_run": F.col("_size")})
    # One row per sorted part, as many as there were tasks.
    return inside.join(F.broadcast(starts), "_part").select(
        "entity_id", (F.col("_start") + F.col("_run") - F.col("_size")).alias("_before")
    )


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value: 2 * sum (-1)^(j-1) exp(-2 j^2 lambda^2)."""
    lam2 = d * d * (n * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(_KS_TERMS)),
        lambda j: F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * j * j * lam2),
    )
    series = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    # Below this distance the p-value is 1 to double precision and the series converges slowly.
    return F.when(lam2 < 0.04, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def exact_p_value(d: float, n: int, m: int) -> float:
    """Two-sided p-value by counting lattice paths from (0, 0) to (n, m) that stay within the distance ``d``.

    Row by row, each row of counts scaled to end with one. Takes n * m additions at most.
    """
    h = round(d * n * m)
    if h <= 0:
        return 1.0
    # |i/n - j/m| < d, in whole numbers: |i*m - j*n| < h.
    paths = (np.arange(m + 1, dtype=np.int64) * n < h).astype(float)
    scale = 0.0
    for i in range(1, n + 1):
        low, high = max(0, (i * m - h) // n + 1), min(m, (i * m + h - 1) // n)
        if low > high:
            return 1.0
        run = np.cumsum(paths[low : high + 1])
        if not run[-1]:
            return 1.0
        scale += math.log(run[-1])
        paths[:low] = 0.0
        paths[low : high + 1] = run / run[-1]
        paths[high + 1 :] = 0.0
    inside = math.log(paths[m]) + scale if paths[m] else -math.inf
    every = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return min(1.0, max(0.0, -math.expm1(min(0.0, inside - every))))


@F.pandas_udf(T.DoubleType())
def _exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) else exact_p_value(x, int(a), int(b)) for x, a, b in zip(d, n, m)], dtype="float64")


def ks_test(d: Column, n: Column, m: Column, exact_rows: int = cfg.KS_EXACT_ROWS) -> Column:
    """p-value: exact where both samples have at most ``exact_rows`` rows, the asymptotic series beyond.

    Exact values under 1e-8 are lost to rounding and come from the series as well.
    """
    series = ks_p_value(d, n.cast("double"), m.cast("double"))
    if exact_rows <= 0:
        return series
    found = _exact(F.when(F.greatest(n, m) <= exact_rows, d), n, m)
    return F.when(found > 1e-8, found).otherwise(series)


def detect_drift(
    reference: DataFrame,
    current: DataFrame,
    threshold: float = cfg.DRIFT_P_VALUE,
    rows_per_slice: int = cfg.ROWS_PER_SLICE,
    features: list[str] | None = None,
    exact_rows: int = cfg.KS_EXACT_ROWS,
) -> DataFrame:
    """KS statistic, p-value, flag and both means per feature.

    ``reference`` comes from ``fit_reference``; features present on one side only
    are left out.  Both sides are counted per distinct value before they meet.
    """
    # Names come from the columns: features of one side only fall out below.
    numeric = [c for c, kind in current.dtypes if kind.startswith(("double", "float", "int", "bigint", "decimal"))]
    now = fit_reference(current, features or [c for c in cfg.DRIFT_FEATURES if c in current.columns] or numeric)
    ref_side = reference.select("feature", "value", F.col("n").alias("a"), F.lit(0).cast("long").alias("b"), "total")
    now_side = now.select("feature", "value", F.lit(0).cast("long").alias("a"), F.col("n").alias("b"), F.lit(0.0).alias("total"))
    both = keep(
        ref_side.unionByName(now_side)
        .groupBy("feature", "value")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("total").alias("total")),
        "drift-counts",
    )
    sizes = keep(
        both.groupBy("feature").agg(
            F.sum("a").alias("n_ref"),
            F.sum("b").alias("n_cur"),
            (F.sum("total") / F.nullif(F.sum("a"), F.lit(0))).alias("reference_mean"),
            (F.sum(F.col("value") * F.col("b")) / F.nullif(F.sum("b"), F.lit(0))).alias("current_mean"),
        ).where((F.col("n_ref") > 0) & (F.col("n_cur") > 0)),
        "drift-sizes",
    )
    slices: Slices | None = fit_slices(both, ["feature"], F.col("value"), rows_per_slice)
    upto = running_sums(both, ["feature"], ["value"], {"ca": F.col("a"), "cb": F.col("b")}, slices)
    withn = attach(upto, sizes, ["feature"]).where(F.col("n_ref").isNotNull())
    gap = F.abs(F.col("ca") / F.col("n_ref") - F.col("cb") / F.col("n_cur"))
    stat = withn.groupBy("feature").agg(F.max(gap).alias("ks_statistic"))
    out = stat.join(F.broadcast(sizes), "feature")  # one row per tracked feature
    p = ks_test(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"), exact_rows)
    return out.withColumn("p_value", p).select(
        "feature", "ks_statistic", "p_value", (F.col("p_value") < threshold).alias("is_drifting"),
        "reference_mean", "current_mean",
    )


def drift_report(drift: DataFrame) -> DataFrame:
    """Formatted table for people."""
    return drift.select(
        "feature",
        F.format_string("%.4f", "reference_mean").alias("reference_mean"),
        F.format_string("%.4f", "current_mean").alias("current_mean"),
        F.format_string("%.4f", "ks_statistic").alias("ks_statistic"),
        F.format_string("%.4e", "p_value").alias("p_value"),
        F.when(F.col("is_drifting"), F.lit("Yes")).otherwise(F.lit("No")).alias("drifting"),
    )


def drift_summary(drift: DataFrame) -> DataFrame:
    return drift.agg(
        F.count(F.lit(1)).alias("features_tracked"),
        F.count_if("is_drifting").alias("features_drifting"),
    )


#: Accuracy parameter of the stored sketches; their rank error is about 1.7 / k at 99 % (``SKETCH_ERROR``).
SKETCH_K = 800
SKETCH_ERROR = 0.0035
#: Points at which the distributions of two sketches are compared, besides their ends.
SKETCH_POINTS = 2000


def fit_sketch(df: DataFrame, features: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Baseline of bounded size per feature: (feature, sketch, n, total), whatever the number of distinct values.

    ``by`` names columns (say, the day): one baseline for each of their values, all in one pass.
    """
    keys, found = by or [], []
    for f in [f for f in features or cfg.DRIFT_FEATURES if f in df.columns]:
        value = F.col(f).cast("double")
        value = F.when(~F.isnan(value), value)
        found.append(
            F.struct(
                F.lit(f).alias("feature"), F.kll_sketch_agg_double(value, SKETCH_K).alias("sketch"),
                F.count(value).alias("n"), F.sum(value).alias("total"),
            )
        )
    per = df.groupBy(*keys).agg(F.array(*found).alias("f")).select(*keys, F.explode("f").alias("f"))
    return per.select(*keys, "f.*").where("n > 0")


def merge_sketches(*baselines: DataFrame) -> DataFrame:
    """One baseline from several (say, of single days, in a table each or in one), without their rows."""
    both = baselines[0]
    for b in baselines[1:]:
        both = both.unionByName(b)
    return both.groupBy("feature").agg(
        F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"), F.sum("n").alias("n"), F.sum("total").alias("total")
    )


def sketched_drift(reference: DataFrame, current: DataFrame, threshold: float = cfg.DRIFT_P_VALUE) -> DataFrame:
    """``detect_drift`` from two sketched baselines: the distance is within 2 * ``SKETCH_ERROR`` of the exact one, at 99 %."""
    side = lambda t, k: t.select("feature", *[F.col(c).alias(f"{c}_{k}") for c in ("sketch", "n", "total")])
    both = side(reference, "ref").join(side(current, "cur"), "feature")
    ranks = F.lit([i / SKETCH_POINTS for i in range(SKETCH_POINTS + 1)])
    quantiles_of = [F.kll_sketch_get_quantile_double(f"sketch_{k}", ranks) for k in ("ref", "cur")]
    points = both.select("feature", F.array_sort(F.array_distinct(F.concat(*quantiles_of))).alias("points"))
    stat = F.lit(None).cast("double")
    # One row per tracked feature, with a bounded number of points.
    for r in points.collect():
        rank = [F.kll_sketch_get_rank_double(f"sketch_{k}", F.lit(r["points"])) for k in ("ref", "cur")]
        gap = F.array_max(F.zip_with(*rank, lambda a, b: F.abs(a - b)))
        stat = F.when(F.col("feature") == r["feature"], gap).otherwise(stat)
    out = both.withColumn("ks_statistic", stat)
    out = out.withColumn("p_value", ks_p_value(F.col("ks_statistic"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double")))
    return out.select(
        "feature", "ks_statistic", "p_value", (F.col("p_value") < threshold).alias("is_drifting"),
        (F.col("total_ref") / F.col("n_ref")).alias("reference_mean"),
        (F.col("total_cur") / F.col("n_cur")).alias("current_mean"),
    )
