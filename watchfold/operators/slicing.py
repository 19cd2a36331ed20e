"""Ordered work on groups of any size.

A window partitioned by a hot key would run in one task.  Here a group with too
many rows is cut into slices along its order, each slice is processed in its own
window partition, and the totals of the earlier slices (one row per slice) are
added back.  Cuts are quantiles of the slice's own rows, so no shape of the values
keeps a slice large, and rows of one value are cut by a tie column.  The results
are exact and equal to the single-window form, which is used where no group is large.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.session import keep

SLICE = "_slice"
_FANOUT = 64  # slices made of one in a round


@dataclass(frozen=True)
class Slices:
    """How the large groups are cut.  ``levels`` hold one row per large slice."""

    keys: tuple[str, ...]
    order: Column
    tie: Column
    levels: tuple[DataFrame, ...]

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the slice number, which grows with the order inside a group."""
        df = df.withColumn(SLICE, F.lit(0).cast("long"))
        for level in self.levels:
            df = _refine(df, level, self.keys, self.order, self.tie)
        return df

    def only_large(self, df: DataFrame) -> DataFrame:
        """The rows of the groups that were cut at all."""
        large = self.levels[0].select(*self.keys).distinct()
        return null_safe_join(df, large, self.keys, "left_semi")


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Equi-join in which a null key matches a null key."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def _refine(df: DataFrame, level: DataFrame, keys, order: Column, tie: Column) -> DataFrame:
    cut = null_safe_join(df, level, [*keys, SLICE])
    at = F.when(F.col("_by_tie"), tie.cast("double")).otherwise(order.cast("double"))
    part = F.size(F.filter("_cuts", lambda c: c < at))
    number = F.col(SLICE) * F.lit(_FANOUT) + F.when(F.col("_cuts").isNull(), 0).otherwise(part)
    return cut.withColumn(SLICE, number.cast("long")).drop("_cuts", "_by_tie")


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group; one map-side combined aggregate."""
    if not keys:
        return df.count()
    top = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return top or 0


def fit_slices(
    df: DataFrame,
    keys: list[str],
    order: Column,
    rows_per_slice: int = cfg.ROWS_PER_SLICE,
    at_most: int | None = None,
    tie: Column | None = None,
) -> Slices | None:
    """Cut every group above ``rows_per_slice`` evenly along ``order``, then ``tie``.

    Each round cuts every slice that is still too large into up to ``_FANOUT`` at its
    quantiles, until none is; slices of a single value of ``order`` are cut by
    ``tie``.  Only rows equal in both stay together.  Returns None when no group
    needs it.  ``at_most`` is a known bound on the rows of the largest group, if any.
    """
    if (largest_group(df, keys) if at_most is None else at_most) <= rows_per_slice:
        return None
    tie = F.lit(0) if tie is None else tie
    slim = df.select(*keys, order.cast("double").alias("_order"), tie.cast("double").alias("_tie"))
    slim = slim.withColumn(SLICE, F.lit(0).cast("long"))
    levels: list[DataFrame] = []
    cuts = [i / _FANOUT for i in range(1, _FANOUT)]
    while len(levels) < 10:  # 64^10 slices
        spread = [F.max(c) > F.min(c) for c in ("_order", "_tie")]
        sizes = slim.groupBy(*keys, SLICE).agg(
            F.count(F.lit(1)).alias("_n"), (~spread[0]).alias("_by_tie"), (spread[0] | spread[1]).alias("_open")
        )
        large = keep(sizes.where((F.col("_n") > rows_per_slice) & F.col("_open")).select(*keys, SLICE, "_by_tie"), "large-slices")
        if large.isEmpty():
            break
        rows = null_safe_join(slim, large.withColumn("_large", F.lit(True)), [*keys, SLICE]).where("_large")
        at = F.when(F.col("_by_tie"), F.col("_tie")).otherwise(F.col("_order"))
        found = rows.groupBy(*keys, SLICE, "_by_tie").agg(F.percentile_approx(at, cuts, 2000).alias("_cuts"), F.max(at).alias("_top"))
        # A cut at the largest value would part nothing; in ascending order, each once.
        apart = F.filter(F.array_distinct("_cuts"), lambda c: c < F.col("_top"))
        low = F.array(F.element_at("_cuts", 1))
        level = keep(found.select(*keys, SLICE, "_by_tie", F.when(F.size(apart) > 0, apart).otherwise(low).alias("_cuts")), "slices")
        levels.append(level)
        slim = _refine(slim, level, keys, F.col("_order"), F.col("_tie"))
    return Slices(tuple(keys), order, tie, tuple(levels)) if levels else None


def running_sums(
    df: DataFrame,
    keys: list[str],
    order_by: list[Column | str],
    sums: dict[str, Column],
    slices: Slices | None = None,
) -> DataFrame:
    """Inclusive running sums inside each group, without one task per group."""
    if slices is None:
        w = _upto(keys, order_by)
        return df.withColumns({n: F.sum(x).over(w) for n, x in sums.items()})
    named = df.withColumns({f"_x_{n}": x for n, x in sums.items()})
    cut = slices.assign(named)
    totals = slices.only_large(cut).groupBy(*keys, SLICE).agg(*[F.sum(f"_x_{n}").alias(f"_t_{n}") for n in sums])
    # One row per slice of a large group: a short window.
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = keep(
        totals.select(*keys, SLICE, *[F.sum(f"_t_{n}").over(earlier).alias(f"_x_{n}") for n in sums]),
        "offsets",
    )
    # What came before a slice is its first row: a join would hold all slices in memory, or shuffle the rows again.
    rows = cut.withColumn("_opened", F.lit(1)).unionByName(offsets.withColumn("_opened", F.lit(0)), allowMissingColumns=True)
    w = _upto([*keys, SLICE], ["_opened", *order_by])
    out = rows.withColumns({n: F.sum(f"_x_{n}").over(w) for n in sums})
    return out.where("_opened = 1").drop(SLICE, "_opened", *[f"_x_{n}" for n in sums])


def _upto(keys, order_by) -> Window:
    return Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)


def quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    names: dict[str, float],
    approx: bool = False,
    rows_per_slice: int = cfg.ROWS_PER_SLICE,
    at_most: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, one output column per name.

    ``at_most`` is a known bound on the rows of the largest group, if any.
    Groups up to ``rows_per_slice`` rows use the built-in percentile.  A larger
    group would put all its distinct values into one buffer, so then the values
    are counted, ranked by sliced running sums and picked by rank.
    """
    group = keys or ["_all"]
    rows = (
        df.withColumn("_all", F.lit(0))
        .select(*group, F.col(value).cast("double").alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    )
    probs = list(names.values())
    if approx:
        agg = F.percentile_approx("_v", probs, 100_000)
    elif (largest_group(rows, keys) if at_most is None else at_most) <= rows_per_slice:
        agg = F.percentile("_v", probs)
    else:
        return _ranked_quantiles(rows, group, names, rows_per_slice).drop("_all")
    picked = rows.groupBy(*group).agg(agg.alias("_q"))
    return picked.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def _ranked_quantiles(rows: DataFrame, keys: list[str], names: dict[str, float], rows_per_slice: int) -> DataFrame:
    counts = keep(rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    slices = fit_slices(counts, keys, F.col("_v"), rows_per_slice)
    ranked = running_sums(counts, keys, ["_v"], {"_upto": F.col("_n")}, slices)
    totals = keep(counts.groupBy(*keys).agg(F.sum("_n").alias("_total")), "value-totals")
    withn = attach(ranked, totals, keys)
    aggs = []
    for i, p in enumerate(names.values()):
        at = F.lit(float(p)) * (F.col("_total") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.min(F.when(F.col("_upto") > rank, F.col("_v"))).alias(f"_{side}{i}"))
        aggs.append(F.first(at - F.floor(at)).alias(f"_f{i}"))
    picked = withn.groupBy(*keys).agg(*aggs)
    return picked.select(
        *keys,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(n)
            for i, n in enumerate(names)
        ],
    )


def attach(rows: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Left-join a fitted table (written by ``keep``) to the rows.

    The written files give Spark the exact size of the table: it is broadcast only
    below ``spark.sql.autoBroadcastJoinThreshold``, else the join is shuffled and
    adaptive execution splits the row side of hot keys.  Rows without a key keep
    missing values.
    """
    return rows.join(dim, keys, "left")
