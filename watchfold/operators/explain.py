"""Why an event looks like an attack: tree attributions, top features, narratives."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.operators.classify import Classifier, importances
from watchfold.operators.sparse import Rows, lists, value_at


@dataclass(frozen=True)
class Paths:
    """All root-to-leaf paths with ``features.shape[1]`` distinct features, the splits merged per feature."""

    features: np.ndarray  # (leaves, length), places in ``PathTable.used``
    low: np.ndarray  # a row follows the path on a feature when low < x <= high
    high: np.ndarray
    kept: np.ndarray  # share of the training rows that follow, per feature
    value: np.ndarray  # (leaves, classes), output per class


#: Leaves whose paths are laid out together.
LEAVES = 1 << 14


@dataclass(frozen=True)
class PathTable:
    """A fitted ensemble as arrays of nodes, tree after tree; the paths are laid out some trees at a time, where they are used."""

    used: np.ndarray  # features that some split uses
    roots: np.ndarray
    leaves: np.ndarray  # per tree
    output: np.ndarray  # per tree: the class of a boosted one, else -1
    feature: np.ndarray  # per node, places in ``used``; -1: a leaf
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cover: np.ndarray
    leaf: np.ndarray  # per node, the row of a leaf in ``value``
    value: np.ndarray
    classes: int

    @property
    def paths(self) -> Iterator[Paths]:
        """All paths but those that add nothing, in groups of ``LEAVES`` leaves, by length."""
        group = np.cumsum(self.leaves) // LEAVES
        for g in np.unique(group):
            yield from self._paths(np.flatnonzero(group == g))

    def share(self, node: np.ndarray, child: np.ndarray) -> np.ndarray:
        return np.divide(self.cover[child], self.cover[node], out=np.zeros(len(node)), where=self.cover[node] != 0)

    def values(self, node: np.ndarray, tree: np.ndarray) -> np.ndarray:
        """Per leaf its part of the output of each class."""
        own = self.value[self.leaf[node]]
        if not len(own) or self.output[0] < 0:
            return own.reshape(len(node), self.classes) / len(self.roots)
        out = np.zeros((len(node), self.classes))
        out[np.arange(len(node)), self.output[tree]] = own[:, 0]
        return out

    def _paths(self, trees: np.ndarray) -> Iterator[Paths]:
        found: dict[int, list[tuple]] = {}
        node, tree = self.roots[trees], trees
        length, n = np.zeros(len(node), np.int64), len(node)
        features = np.full((n, 1), -1, np.int32)
        low, high, kept = np.full((n, 1), -np.inf), np.full((n, 1), np.inf), np.ones((n, 1))
        while len(node):
            ends = self.feature[node] < 0
            for m in np.unique(length[ends & (length > 0)]):
                of = np.flatnonzero(ends & (length == m))
                v = self.values(node[of], tree[of])
                of, v = of[v.any(axis=1)], v[v.any(axis=1)]
                found.setdefault(int(m), []).append((features[of, :m], low[of, :m], high[of, :m], kept[of, :m], v))
            # Every inner node twice: as it goes on to the left, then to the right.
            of = np.repeat(np.flatnonzero(~ends), 2)
            if not len(of):
                break
            parent, left = node[of], np.arange(len(of)) % 2 == 0
            features, low, high, kept = (np.pad(x[of], ((0, 0), (0, 1)), constant_values=c) for x, c in (
                (features, -1), (low, -np.inf), (high, np.inf), (kept, 1.0)
            ))
            node, tree, length, rows = np.where(left, self.left[parent], self.right[parent]), tree[of], length[of], np.arange(len(of))
            split, cut = self.feature[parent], self.threshold[parent]
            same = features == split[:, None]
            at = np.where(same.any(axis=1), same.argmax(axis=1), length)
            length = np.maximum(length, at + 1)
            features[rows, at] = split
            high[rows, at] = np.where(left, np.minimum(high[rows, at], cut), high[rows, at])
            low[rows, at] = np.where(left, low[rows, at], np.maximum(low[rows, at], cut))
            kept[rows, at] *= self.share(parent, node)
        for _, parts in sorted(found.items()):
            yield Paths(*(np.concatenate(c) for c in zip(*parts)))

    @property
    def expected(self) -> np.ndarray:
        """Mean output per class."""
        out, node, tree = np.zeros(self.classes), self.roots, np.arange(len(self.roots))
        reach = np.ones(len(node))
        while len(node):
            ends = self.feature[node] < 0
            out += (self.values(node[ends], tree[ends]) * reach[ends, None]).sum(axis=0)
            node, tree, reach = node[~ends], tree[~ends], reach[~ends]
            sides = [self.left[node], self.right[node]]
            reach = np.concatenate([reach * self.share(node, child) for child in sides])
            node, tree = np.concatenate(sides), np.concatenate([tree, tree])
        return out


def path_table(classifier: Classifier) -> PathTable:
    """The node table (bounded by the settings of the model) as arrays, without an object per node."""
    kept = ["tree", "output", "node", "feature", "threshold", "left_node", "right_node", "cover"]
    ends = F.when(F.col("feature") < 0, F.col("value")).alias("value")
    table = classifier.nodes.select(*kept, ends).sort("tree", "output", "node").toArrow().combine_chunks()
    col = {c: table[c].to_numpy() for c in kept}
    n = table.num_rows
    new = np.r_[True, (col["tree"][1:] != col["tree"][:-1]) | (col["output"][1:] != col["output"][:-1])][:n]
    group, roots = np.cumsum(new) - 1, np.flatnonzero(new)
    inner = col["feature"] >= 0
    used = np.unique(col["feature"][inner]).astype(np.int64)
    step = int(col["node"].max(initial=0)) + 1
    key = group * step + col["node"]

    def place(side: str) -> np.ndarray:
        out = np.zeros(n, np.int32)
        out[inner] = np.searchsorted(key, (group * step + col[side])[inner])
        return out

    sizes = table["value"].combine_chunks().value_lengths().fill_null(0).to_numpy() if n else np.zeros(0)
    width = int(sizes.max(initial=1)) or 1
    value = table["value"].combine_chunks().flatten().to_numpy().reshape(-1, width) if n else np.zeros((0, width))
    feature = np.where(inner, np.searchsorted(used, col["feature"]), -1).astype(np.int32)
    output = col["output"][roots] if classifier.boosted else np.full(len(roots), -1)
    return PathTable(
        used, roots, np.bincount(group[~inner], minlength=len(roots)), output, feature, col["threshold"], place("left_node"),
        place("right_node"), col["cover"], (np.cumsum(~inner) - 1).astype(np.int32), value, len(classifier.classes),
    )


#: Numbers in one array operation over (rows, leaves, path, points).
_AT_ONCE = 1 << 21
#: Rows that are done with some leaves at least.
_ROWS = 32


def shapley(x: np.ndarray, classes: np.ndarray, table: PathTable) -> np.ndarray:
    """Exact path-dependent Shapley values of each row for its class; ``x`` has one column per used feature.

    The weighted sum over feature subsets of a leaf equals the integral over u in
    (0, 1) of prod_j (kept_j (1 - u) + follows_j u); it is a polynomial, so Gauss
    points integrate it exactly. Some rows and some leaves of one path length are done
    together.
    """
    out = np.zeros(x.shape)
    for p in table.paths:
        m = p.features.shape[1]
        at, w = np.polynomial.legendre.leggauss(m // 2 + 1)
        u, w = (at + 1) / 2, w / 2
        for c in np.unique(classes):
            able, rows = np.flatnonzero(p.value[:, c]), np.flatnonzero(classes == c)
            most = max(1, _AT_ONCE // (_ROWS * m * len(u)))
            for some in np.split(able, range(most, len(able), most)) if len(able) else ():
                step = max(1, _AT_ONCE // (len(some) * m * len(u)))
                kept = p.kept[some][None]
                for i in range(0, len(rows), step):
                    mine = rows[i : i + step]
                    cols = x[mine][:, p.features[some]]  # rows, leaves, path
                    follows = ((cols > p.low[some]) & (cols <= p.high[some])).astype(float)
                    blend = kept[..., None] * (1 - u) + follows[..., None] * u
                    whole = np.prod(blend, axis=2)
                    without = ((whole[:, :, None, :] / np.maximum(blend, 1e-300)) * w).sum(axis=3)
                    shares = p.value[some, c][None, :, None] * (follows - kept) * without
                    to = np.arange(len(mine))[:, None] * x.shape[1] + p.features[some].ravel()[None]
                    sums = np.bincount(to.ravel(), shares.reshape(len(mine), -1).ravel(), len(mine) * x.shape[1])
                    out[mine] += sums.reshape(len(mine), -1)
    return out


def attribute(
    vectors: DataFrame, classifier: Classifier, attack_col: str = "attack", only: Column | None = None
) -> DataFrame:
    """Add ``shap`` and ``shap_features``: attribution and value of every feature that the model uses, for the row's class.

    ``used_features`` names them; all others have no part in any output.  Rows without a
    known class are explained for the first class, rows outside ``only`` get null and
    are not sent to the model.  A narrow map; the path table is bounded by the model and
    broadcast once.
    """
    shared = classifier.sent("paths", path_table)

    @F.arrow_udf("struct<shap:array<double>,x:array<double>>")
    def explain(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for features, classes in batches:
            known = classes.is_valid().to_numpy(zero_copy_only=False)
            rows, wanted = Rows.of(features.filter(pa.array(known))), classes.drop_null().to_numpy()
            x = rows.columns(shared.value.used)
            yield pa.StructArray.from_arrays(
                [lists(shapley(x, wanted, shared.value), known), lists(x, known)], names=["shap", "x"]
            )

    names = F.array(*[F.lit(c) for c in classifier.classes])
    code = F.greatest(F.array_position(names, F.coalesce(F.col(attack_col), F.lit(""))) - 1, F.lit(0)).cast("int")
    features = F.col("features")
    if only is not None:
        code, features = F.when(only, code), F.when(only, features)
    told = vectors.withColumn("_told", explain(features, code))
    return told.withColumns({"shap": F.col("_told.shap"), "shap_features": F.col("_told.x")}).drop("_told")


def used_features(classifier: Classifier) -> list[str]:
    """Names of the features that some split of the model uses, in the order of ``shap``."""
    return [classifier.features[i] for i in classifier.sent("paths", path_table).value.used]


def top_of(attributed: DataFrame, classifier: Classifier, k: int = 5) -> DataFrame:
    """Add ``top_features`` of rows that ``attribute`` made."""
    return top_features(attributed, used_features(classifier), k, features="shap_features")


def expected_output(classifier: Classifier, spark: SparkSession) -> list[float]:
    """Mean model output per class: the value attributions start from."""
    return [float(v) for v in classifier.sent("paths", path_table).value.expected]


def _entries(names: Column, shap: Column, values: Column, k: int, steady: bool) -> Column:
    zipped = F.arrays_zip(names, shap, values).cast("array<struct<f:string,s:double,v:double>>")
    keyed = F.transform(
        zipped,
        lambda e: F.struct(
            (-F.abs(e["s"])).alias("size"), e["f"].alias("f"), e["s"].alias("s"), e["v"].alias("v")
        ),
    )
    best = F.slice(F.array_sort(keyed), 1, k)

    def entry(e: Column, i: Column) -> Column:
        up = F.lit(True) if steady else e["s"] > 0
        return F.struct(
            (i + 1).cast("int").alias("rank"),
            e["f"].alias("feature"),
            sc.human_name(e["f"]).alias("human_name"),
            F.round(e["s"], 4).alias("shap_value"),
            F.round(e["v"], 4).alias("feature_value"),
            F.when(up, F.lit("increases_risk")).otherwise(F.lit("decreases_risk")).alias("direction"),
        )

    return F.transform(best, entry)


def top_features(
    attributed: DataFrame, names: list[str] | Column, k: int = 5, shap: str = "shap", features: str = "features"
) -> DataFrame:
    """Add ``top_features``: the k largest impacts by size, within the row."""
    labels = names if isinstance(names, Column) else F.array(*[F.lit(n) for n in names])
    return attributed.withColumn("top_features", _entries(labels, F.col(shap), F.col(features), k, steady=False))


def fallback_features(vectors: DataFrame, classifier: Classifier, k: int = 5) -> DataFrame:
    """Global importances in place of attributions: same shape, always increasing."""
    best = importances(classifier, vectors.sparkSession).orderBy(F.desc("importance"), "feature").limit(k).collect()
    names = F.array(*[F.lit(r["feature"]) for r in best])
    shares = F.array(*[F.lit(float(r["importance"])) for r in best])
    values = F.array(*[value_at(vectors, classifier.features.index(r["feature"])) for r in best])
    return vectors.withColumn("top_features", _entries(names, shares, values, k, steady=True))


def long_form(explained: DataFrame) -> DataFrame:
    """(event_id, rank, feature, human_name, shap_value, feature_value, direction)."""
    return explained.select("event_id", F.explode("top_features").alias("t")).select("event_id", "t.*")


def narrative(top: Column, attack: Column | None = None) -> Column:
    """Numbered lines for an analyst."""
    lines = F.transform(
        top,
        lambda t: F.format_string(
            "  %d. **%s** (Value: %s) -> Contribution Score: %+.4f",
            t["rank"], t["human_name"], t["feature_value"].cast("string"), t["shap_value"],
        ),
    )
    head = F.lit("Top Behavioral Anomalies & Risk Drivers:")
    body = F.concat_ws("\n", F.array(head), lines)
    if attack is None:
        return body
    return F.concat_ws("\n", F.concat(F.lit("Attack Classification: **"), attack, F.lit("**")), body)


def analyst_summary(top: Column, attack: Column, level: Column) -> Column:
    """One paragraph naming the two strongest features."""
    name = lambda i: F.lower(F.get(top, F.lit(i))["human_name"])
    reason = F.concat(
        F.lit("primarily due to anomalous **"), name(0), F.lit("**"),
        F.coalesce(F.concat(F.lit(", combined with unusual **"), name(1), F.lit("**")), F.lit("")),
    )
    kind = F.coalesce(F.nullif(attack, F.lit("")), F.lit("General Anomaly"))
    return F.format_string(
        "This event was flagged %s. "
        "The behavioral pattern strongly correlates with a **%s** attack and poses a **%s** risk to the organization. "
        "Review the detailed SHAP contributions and automated SOAR actions to proceed with mitigation.",
        reason, kind, F.coalesce(level, F.lit("Unknown")),
    )


def contribution_table(explained: DataFrame) -> DataFrame:
    """Top features of each event, smallest value first, with a sign colour."""
    return long_form(explained).select(
        "event_id", "human_name", "shap_value",
        F.when(F.col("shap_value") > 0, F.lit("red")).otherwise(F.lit("green")).alias("colour"),
    )


def global_summary(classifier: Classifier, vectors: DataFrame, k: int = cfg.TOP_IMPORTANCES) -> DataFrame:
    """The model's strongest features with analyst-facing names."""
    spark = vectors.sparkSession
    table = {r["feature"]: r["importance"] for r in importances(classifier, spark).collect()}
    best = sorted(table.items(), key=lambda item: (-item[1], item[0]))[:k]
    size = min(cfg.SUMMARY_ROWS, vectors.count())
    rows = [(i + 1, f, float(v), size) for i, (f, v) in enumerate(best)]
    out = spark.createDataFrame(rows, "rank int, feature string, importance double, sample_size int")
    return out.withColumns(
        {"human_name": sc.human_name(F.col("feature")), "importance": F.round("importance", 4)}
    ).select("rank", "feature", "human_name", "importance", "sample_size")


def sample_event(flagged: DataFrame, classes: list[str]) -> DataFrame:
    """First flagged event of a known attack class, else the first flagged one."""
    known = F.coalesce(F.col("anomaly_type").isin(*classes), F.lit(False))
    order = F.struct(F.when(known, 0).otherwise(1), F.col("event_id"))
    return flagged.agg(F.min_by(F.struct("event_id", "anomaly_type"), order).alias("e")).select("e.*")
