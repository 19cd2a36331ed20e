"""Isolation forest as Spark jobs: sampled per tree, grown per tree, scored per row."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.operators.slicing import quantiles
from watchfold.operators.sparse import Rows, Walk, is_sparse, sparse
from watchfold.session import keep

NODES = (
    "tree int, node int, feature int, threshold double, left_node int, right_node int, size int, depth int"
)
_HASH_RANGE = 1 << 31
_OVERSAMPLE = 1.5


@dataclass(frozen=True)
class Forest:
    """Fitted trees (a table of at most trees * (2 * sample - 1) nodes) and calibration."""

    nodes: DataFrame
    features: tuple[str, ...]
    sample: int
    offset: float = -0.5
    low: float = cfg.LIVE_BOUNDS[0]
    high: float = cfg.LIVE_BOUNDS[1]
    _sent: dict = field(default_factory=dict, compare=False, repr=False)

    def trees(self) -> Broadcast:
        """The node table as arrays, sent to the workers once."""
        if "trees" not in self._sent:
            arrays = _Trees(self.nodes.toArrow().to_pandas(), self.sample)
            self._sent["trees"] = self.nodes.sparkSession.sparkContext.broadcast(arrays)
        return self._sent["trees"]

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(list(self.features), self.sample, self.offset, self.low, self.high)]
        spark.createDataFrame(
            meta, "features array<string>, sample int, offset double, low double, high double"
        ).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Forest":
        m = spark.read.parquet(f"{path}/meta").first()
        return Forest(
            spark.read.parquet(f"{path}/nodes"), tuple(m["features"]), m["sample"], m["offset"], m["low"], m["high"]
        )


def mean_depth(n) -> np.ndarray:
    """Average path length of an unsuccessful search among n points (Liu et al. 2008)."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def sample_trees(
    vectors: DataFrame, rows: int, trees: int, sample: int, seed: int
) -> DataFrame:
    """(tree, event_id, features): exactly ``sample`` rows without replacement per tree, independent between trees.

    A row is a candidate of each tree with one small probability, whatever the others
    do: one hash per row gives its first tree by the geometric distribution, and only
    rows that have one draw for the trees after it. Of a tree's candidates the
    ``sample`` smallest of another hash stay. About trees * sample * 1.5 rows are
    shuffled, however many there are. Should a tree get too few candidates, the
    probability is doubled and all is drawn anew.
    """
    def draw(*parts: Column) -> Column:
        return (F.pmod(F.xxhash64("event_id", *parts, F.lit(seed)), F.lit(_HASH_RANGE)) + 0.5) / _HASH_RANGE

    size = min(sample, rows)
    rate = _OVERSAMPLE * size / max(rows, 1)
    while True:
        if rate < 1.0:
            first = F.floor(F.log(1.0 - draw(F.lit(-1))) / F.lit(math.log1p(-rate))).cast("int")
            rest = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: (t > F.col("_first")) & (draw(t) < rate))
            some = vectors.withColumn("_first", first).where(F.col("_first") < trees)
            drawn = some.withColumn("_trees", F.concat(F.array("_first"), rest))
        else:
            drawn = vectors.withColumn("_trees", F.sequence(F.lit(0), F.lit(trees - 1)))
        drawn = drawn.select(F.explode("_trees").alias("tree"), "event_id", "features")
        order = Window.partitionBy("tree").orderBy(draw(F.col("tree"), F.lit(1)), "event_id")
        ranked = drawn.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size)
        ranked = keep(ranked.drop("_rank"), "tree-samples")
        if rate >= 1.0 or ranked.count() == trees * size:
            return ranked
        rate *= 2


def _grow(pdf: pd.DataFrame, width: int, limit: int, share: float, seed: int) -> pd.DataFrame:
    """One tree from at most ``sample`` rows."""
    pdf = pdf.sort_values("event_id")
    tree = int(pdf["tree"].iloc[0])
    rng = np.random.default_rng([seed, tree])
    usable = rng.choice(width, max(1, int(share * width)), replace=False)
    # Features that are zero in all rows cannot be split on.
    sizes = pdf["at"].map(len).to_numpy()
    at, row = np.concatenate(pdf["at"].to_numpy()).astype(np.int64), np.repeat(np.arange(len(pdf)), sizes)
    usable = usable[np.isin(usable, at)]
    place = np.full(width, -1)
    place[usable] = np.arange(len(usable))
    hit = place[at] >= 0
    x = np.zeros((len(pdf), len(usable)))
    x[row[hit], place[at[hit]]] = np.concatenate(pdf["x"].to_numpy())[hit]
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, -1, False)]
    while todo:
        idx, depth, parent, is_right = todo.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][5 if is_right else 4] = me
        nodes.append([tree, me, -1, 0.0, -1, -1, len(idx), depth])
        if depth >= limit or len(idx) <= 1:
            continue
        part = x[idx]
        if not part.shape[1]:
            continue
        low, high = part.min(axis=0), part.max(axis=0)
        varied = np.flatnonzero(high > low)
        if not len(varied):
            continue
        pick = rng.choice(varied)
        cut = rng.uniform(low[pick], high[pick])
        goes_left = part[:, pick] <= cut
        nodes[me][2:4] = [int(usable[pick]), float(cut)]
        todo.append((idx[~goes_left], depth + 1, me, True))
        todo.append((idx[goes_left], depth + 1, me, False))
    names = [f.split()[0] for f in NODES.split(", ")]
    return pd.DataFrame(nodes, columns=names)


def fit_forest(
    vectors: DataFrame,
    features: list[str],
    trees: int = cfg.FOREST_TREES,
    sample: int = cfg.FOREST_SAMPLE,
    share: float = cfg.FOREST_FEATURE_SHARE,
    seed: int = cfg.FOREST_SEED,
) -> Forest:
    """Grow the trees; every group handed to Python has at most ``sample`` rows."""
    rows = vectors.count()
    size = min(sample, rows)
    limit = max(1, math.ceil(math.log2(max(size, 2))))
    width = len(features)
    drawn = sample_trees(vectors, rows, trees, size, seed)
    cells = F.col("features") if is_sparse(vectors) else sparse(F.col("features"))
    drawn = drawn.select("tree", "event_id", cells.alias("c")).select("tree", "event_id", "c.at", "c.x")
    nodes = drawn.groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, width, limit, share, seed), NODES)
    return Forest(keep(nodes, "forest-nodes"), tuple(features), size)


class _Trees:
    """The node table as padded arrays, one row per tree."""

    def __init__(self, nodes: pd.DataFrame, sample: int):
        nodes = nodes.sort_values(["tree", "node"])
        trees = nodes["tree"].unique()
        shape = (len(trees), int(nodes["node"].max()) + 1)
        row = nodes["tree"].map({t: i for i, t in enumerate(trees)}).to_numpy()
        col = nodes["node"].to_numpy()
        feature, left, right = (np.full(shape, -1) for _ in range(3))
        threshold = np.zeros(shape)
        self.path = np.zeros(shape)
        split = nodes["feature"].to_numpy()
        self.used = np.unique(split[split >= 0]).astype(np.int64)
        feature[row, col] = np.where(split >= 0, np.searchsorted(self.used, split), -1)
        threshold[row, col], left[row, col], right[row, col] = nodes["threshold"], nodes["left_node"], nodes["right_node"]
        self.path[row, col] = nodes["depth"] + mean_depth(nodes["size"])
        self.walk = Walk(feature, threshold, left, right)
        self.unit = float(mean_depth(sample)) or 1.0

    def score(self, vectors: Rows) -> np.ndarray:
        x = vectors.columns(self.used) if len(self.used) else np.zeros((vectors.n, 1))
        total = np.zeros(len(x))
        for rows, t, at in self.walk.leaves(x):
            total[rows] += self.path[t].take(at)
        return np.power(2.0, -total / len(self.path) / self.unit)


def isolation(vectors: DataFrame, forest: Forest) -> DataFrame:
    """Add ``isolation`` in (0, 1]; a narrow map, the forest is small and broadcast."""
    trees = forest.trees()

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(trees.value.score(Rows.of(batch)))

    return vectors.withColumn("isolation", score("features"))


def decision(forest: Forest) -> Column:
    """Below 0 means anomalous."""
    return -F.col("isolation") - F.lit(forest.offset)


def calibrate(
    forest: Forest,
    isolated: DataFrame,
    contamination: float = cfg.FOREST_CONTAMINATION,
    approx: bool = False,
    rows_per_slice: int = cfg.ROWS_PER_SLICE,
) -> Forest:
    """Threshold at the contamination quantile, and the bounds for the 0-100 scale."""
    raw = isolated.select((-F.col("isolation")).alias("raw"))
    cut = quantiles(raw, [], "raw", {"offset": contamination}, approx, rows_per_slice).first()["offset"]
    ends = raw.agg(F.min("raw").alias("low"), F.max("raw").alias("high")).first()
    return replace(forest, offset=float(cut), low=float(ends["low"] - cut), high=float(ends["high"] - cut))


def prediction(decided: Column) -> Column:
    return F.when(decided < 0, F.lit(-1)).otherwise(F.lit(1))


def rescale(decided: Column, low: float, high: float) -> Column:
    """0-100, higher is more anomalous; a constant score gives 0."""
    if high == low:
        return F.lit(0.0)
    return (F.lit(high) - decided) / F.lit(high - low) * F.lit(100.0)


def rescale_live(decided: Column, low: float = cfg.LIVE_BOUNDS[0], high: float = cfg.LIVE_BOUNDS[1]) -> Column:
    """Same scale with given bounds, clamped because live rows may exceed them."""
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), rescale(decided, low, high)))


def score_forest(vectors: DataFrame, forest: Forest, live: bool = False) -> DataFrame:
    """Add prediction (-1 / 1) and anomaly_score (0-100)."""
    out = vectors if "isolation" in vectors.columns else isolation(vectors, forest)
    d = decision(forest)
    scale = rescale_live if live else rescale
    return out.withColumns(
        {"prediction": prediction(d), "anomaly_score": scale(d, forest.low, forest.high)}
    )


def rescale_column(df: DataFrame, raw: str) -> DataFrame:
    """Min-max form of ``rescale`` for a score column of any origin."""
    ends = df.agg(F.min(raw).alias("low"), F.max(raw).alias("high")).first()
    return df.withColumn("anomaly_score", rescale(F.col(raw), float(ends["low"]), float(ends["high"])))
