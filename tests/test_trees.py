"""Histogram trees: the joint Spark jobs, the per-task growth and the plain definition give the same splits."""

from operator import methodcaller
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from watchfold.operators import classify as cl
from watchfold.operators import sparse as sparse_rows
from watchfold.operators import trees
from watchfold.operators.sparse import Rows, lists, sparse


def table(spark, n=150, seed=1, classes=3, folds=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)), 1)
    x[:, 4] = rng.random(n) < 0.3
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] + x[:, 4] > 0.4)
    y = np.where(rng.random(n) < 0.1, rng.integers(classes, size=n), y)
    rows = [(i, [float(v) for v in x[i]], int(y[i]), i % folds) for i in range(n)]
    return x, y, spark.createDataFrame(rows, "event_id long, features array<double>, class_code int, fold int")


SHAPE = ["member", "tree", "output", "node", "feature", "threshold", "left_node", "right_node"]


@pytest.mark.parametrize("boosted", [True, False])
def test_blocks_grow_the_same_trees_as_one(spark, monkeypatch, boosted):
    _, _, df = table(spark, folds=2)
    plans = [
        trees.Plan(boosted, 4, 3, balanced=k == 1, held_out=k - 1, leaves=5 if boosted and k == 1 else 0, least_rows=1 + k)
        for k in range(3)
    ]
    one = trees.fit_trees(df.coalesce(1), plans, 3, 7).select(*SHAPE)
    monkeypatch.setattr(trees, "BLOCK", 32)
    monkeypatch.setattr(trees, "SNAPSHOT", 3)
    monkeypatch.setattr(trees, "HISTOGRAMS", 40_000)
    many = trees.fit_trees(df.repartition(3), plans, 3, 7).select(*SHAPE)
    assert one.count() == many.count() and one.exceptAll(many).isEmpty()
    assert one.select("member").distinct().count() == 3


@pytest.mark.parametrize("boosted", [True, False])
def test_few_blocks_need_no_job_per_level(spark, monkeypatch, boosted):
    """A table of several blocks is grown by one task per member, with the trees of the joint jobs."""
    _, _, df = table(spark, folds=2)
    plans = [
        trees.Plan(boosted, 6, 4, balanced=k == 1, held_out=k - 1, leaves=5 if boosted and k == 1 else 0, least_rows=1 + k)
        for k in range(3)
    ]
    monkeypatch.setattr(trees, "BLOCK", 32)
    with monkeypatch.context() as joint:
        joint.setattr(trees, "APART", 0)
        joint.setattr(trees, "SNAPSHOT", 3)
        want = trees.fit_trees(df.repartition(3), plans, 3, 7).select(*SHAPE, "cover")
    monkeypatch.setattr(trees, "_splits", None)  # no job that adds up histograms
    got = trees.fit_trees(df.repartition(3), plans, 3, 7).select(*SHAPE, "cover")
    shape = lambda d: d.withColumn("cover", F.round("cover", 6))
    assert want.count() == got.count() and shape(got).exceptAll(shape(want)).isEmpty()


def test_first_split_is_the_best_of_all(spark):
    """One boosted round on all rows and columns: the root split has the largest gain that any cut can have."""
    x, y, df = table(spark)
    plan = trees.Plan(True, 1, 1, balanced=False, rows=1.0, columns=1.0, least_weight=0.0)
    nodes = trees.fit_trees(df, [plan], 3, 1).where("node = 0").collect()
    assert len(nodes) == 3
    for node in nodes:
        k = node["output"]
        g, h = 1 / 3 - (y == k), np.full(len(y), 2 / 3 * 2 / 3)
        score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
        gains = {
            (f, c): score(x[:, f] <= c) + score(x[:, f] > c) - score(np.ones(len(y), bool))
            for f in range(5) for c in np.unique(x[:, f])[:-1] + 1e-9
        }
        assert node["gain"] == pytest.approx(max(gains.values()))
        left = x[:, node["feature"]] <= node["threshold"]
        assert score(left) + score(~left) - score(np.ones(len(y), bool)) == pytest.approx(node["gain"])


def test_leaves_are_taken_best_first(spark):
    x, y, df = table(spark, n=400)
    full = trees.Plan(True, 1, 6, balanced=False, rows=1.0, columns=1.0, leaves=0)
    few = trees.Plan(True, 1, 6, balanced=False, rows=1.0, columns=1.0, leaves=6)
    a, b = (trees.fit_trees(df, [p], 3, 1).where("output = 1").toPandas().set_index("node") for p in (full, few))
    assert (b["feature"] >= 0).sum() == 5
    chosen, open_now = [], [0]
    while len(chosen) < 5:
        node = max(open_now, key=lambda n: a.loc[n, "gain"])
        open_now.remove(node)
        chosen.append(node)
        open_now += [c for c in (a.loc[node, "left_node"], a.loc[node, "right_node"]) if a.loc[c, "feature"] >= 0]
    key = lambda t, nodes: sorted((t.loc[n, "feature"], t.loc[n, "threshold"], t.loc[n, "cover"]) for n in nodes)
    assert key(a, chosen) == key(b, b.index[b["feature"] >= 0])


def test_held_out_rows_play_no_part(spark):
    _, _, df = table(spark, folds=2)
    changed = df.withColumn("class_code", F.when(F.col("fold") == 1, F.lit(0)).otherwise(F.col("class_code")))
    plan = trees.Plan(True, 3, 3, balanced=False, held_out=1)
    a, b = (trees.fit_trees(d.coalesce(1), [plan], 3, 7).select(*SHAPE, "value") for d in (df, changed))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_scores_follow_the_node_table(spark):
    x, _, df = table(spark)
    nodes = trees.fit_trees(df, [trees.Plan(True, 3, 3, balanced=True)], 3, 7).toPandas()
    model = trees.Ensemble(nodes, True, 3)
    got = model.outputs(Rows.of(pa.array([list(r) for r in x])))
    want = np.zeros((len(x), 3))
    for (_, output), tree in nodes.groupby(["tree", "output"]):
        rows = {r.node: r for r in tree.itertuples()}
        for i in range(len(x)):
            r = rows[0]
            while r.feature >= 0:
                r = rows[r.left_node if x[i, r.feature] <= r.threshold else r.right_node]
            want[i, output] += r.value[0]
    np.testing.assert_allclose(got, want)


def test_few_rows_and_empty_classes(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0], 0, 0)], "event_id long, features array<double>, class_code int, fold int")
    for boosted in (True, False):
        nodes = trees.fit_trees(one, [trees.Plan(boosted, 2, 3, balanced=True)], 2, 1)
        assert nodes.where("feature >= 0").isEmpty() and nodes.count() > 0


def test_sparse_rows():
    dense = pa.array([[0.0, 2.0, 0.0], [0.0, 0.0, 0.0], [1.0, 0.0, -3.0]])
    struct = pa.array([{"at": [1], "x": [2.0]}, {"at": [], "x": []}, {"at": [0, 2], "x": [1.0, -3.0]}])
    for rows in (Rows.of(dense), Rows.of(struct), Rows.of(pa.concat_arrays([struct, struct]).slice(3, 3))):
        assert rows.columns(np.array([0, 2, 7])).tolist() == [[0, 0, 0], [0, 0, 0], [1, -3, 0]]
        place, entry = rows.entries(np.array([2, 0]))
        assert place.tolist() == [0, 0, 1] and rows.x[entry].tolist() == [1, -3, 2]
    assert lists(np.array([[1, 2], [3, 4]]), np.array([True, False, True])).to_pylist() == [[1, 2], None, [3, 4]]


def test_sparse_column(spark):
    got = spark.createDataFrame([([0.0, 2.0, 0.0, -1.0],)], "v array<double>").select(sparse(F.col("v")).alias("s")).first()["s"]
    assert got["at"] == [1, 3] and got["x"] == [2.0, -1.0]


def test_unflagged_rows_are_not_sent(spark):
    x, y, df = table(spark)
    attacks = df.selectExpr("event_id", "features", "'Anomaly' AS label", "concat('c', class_code) AS anomaly_type")
    model = cl.train_model(attacks, list("abcde"), "boosted", cl.Effort(rounds=5))
    scored = attacks.withColumn("prediction", F.when(F.col("event_id") % 2 == 0, -1).otherwise(1))
    out = {r["event_id"]: r["attack"] for r in cl.classify_flagged(scored, model).collect()}
    every = {r["event_id"]: r["attack"] for r in cl.classify(scored, model).collect()}
    assert all(out[i] == (every[i] if i % 2 == 0 else "Normal") for i in out)
    margins = scored.withColumn("margins", cl.outputs(F.col("features"), model))
    shares = margins.select(cl.probabilities(F.col("margins"), model).alias("p")).first()["p"]
    assert sum(shares) == pytest.approx(1)


@pytest.mark.parametrize("boosted", [True, False])
@pytest.mark.parametrize("step", [1, 1 << 18])
def test_nodes_of_a_level_are_compared_at_once(spark, monkeypatch, boosted, step):
    """A task compares the nodes of a level in groups, and finds what ``Job.best`` finds one by one."""
    _, _, df = table(spark, n=300, folds=2)
    rows = df.select("event_id", sparse(F.col("features")).alias("features"), "class_code", "fold")
    bins = trees.fit_bins(rows)
    plan = trees.Plan(boosted, 3, 5, balanced=False, held_out=1, leaves=7 if boosted else 0, least_rows=2)
    weights = np.array([[1.0, 2.0, 0.5]])
    parts = trees._blocks_of(rows, 300, bins, 0).toPandas().to_dict("records")
    job = trees.Job((plan,), bins, 3, weights, 7, 0, (), (), {})
    monkeypatch.setattr(trees, "STEP", step)

    def grow():
        held = trees.Held(parts, job)
        return trees._grow_units(held.splits, held.advance, job, [(0, 0, 3)], 1)

    with monkeypatch.context() as alone:
        alone.setattr(trees.Job, "best", None)  # not called node by node
        got = grow()

    class Plain:
        """All histograms from all rows, for each level anew."""

        def __init__(self):
            self.block = trees.Block(parts[0] | {"margins": np.zeros(900 if boosted else 0).tobytes()}, 3)

        def splits(self, job):
            return [job.best(i, node, sums) for i, node, sums in job.histograms(self.block)]

        def advance(self, job):
            self.block.margins = job.margins(self.block, trees.Columns(self.block, bins, list(job.pending)))

    plain = Plain()
    want = trees._grow_units(plain.splits, plain.advance, job, [(0, 0, 3)], 1)
    key = lambda ts: [(t.output, t.feature, t.cut, t.left, t.right, [round(g, 6) for g in t.gain]) for t in ts]
    assert key(got) == key(want) and any(f >= 0 for t in got for f in t.feature)


@pytest.mark.parametrize("boosted", [True, False])
def test_a_task_of_its_own_holds_small_numbers(spark, monkeypatch, boosted):
    """A byte per row and feature and two per entry; rows are added up in stretches, and the trees stay the same."""
    _, _, df = table(spark, n=300, folds=2)
    rows = df.select("event_id", sparse(F.col("features")).alias("features"), "class_code", "fold")
    bins = trees.fit_bins(rows)
    plan = trees.Plan(boosted, 3, 5, balanced=False, held_out=1)
    monkeypatch.setattr(trees, "BLOCK", 32)
    parts = trees._blocks_of(rows, 300, bins, 0).toPandas().to_dict("records")
    job = trees.Job((plan,), bins, 3, np.ones((1, 3)), 7, 0, (), (), {})

    def grow():
        held = trees.Held(parts, job)
        assert held.cells.dtype == np.uint16 and held.matrix.dtype == np.uint8 and not len(held.columns)
        size = sum(v.nbytes for v in [*vars(held).values(), *vars(held.block).values()] if isinstance(v, np.ndarray))
        assert size <= 300 * (len(bins.features) + 2 * len(bins.features) + 24 + 24) + 1000
        return trees._grow_units(held.splits, held.advance, job, [(0, 0, 3)], 1)

    key = lambda ts: [(t.output, t.feature, t.cut, t.left, t.right, [round(g, 6) for g in t.gain]) for t in ts]
    want = key(grow())
    monkeypatch.setattr(trees, "STRETCH", 7)
    assert key(grow()) == want


def test_tables_of_a_million_attacks_need_no_job_per_level():
    assert trees.APART * trees.BLOCK >= 1_000_000


def test_members_answer_the_rows_of_their_fold(spark):
    class_by_value = SimpleNamespace(outputs=methodcaller("columns", np.arange(2)))
    data = [(i, i % 5, 0.0, ([0, 1], [1.0, float(i)])) for i in range(10)]
    dealt = spark.createDataFrame(data, f"event_id long, fold int, class_code double, features {trees.ROW}").coalesce(1)
    counts = cl._answers(dealt, [("a", k, class_by_value) for k in range(5)], ["a"])
    # row 1 has equal values and rows 0 the smaller one; all others are above
    assert counts == {("a", 0): {(0, 0): 1, (0, 1): 1}, ("a", 1): {(0, 0): 1, (0, 1): 1}} | {("a", k): {(0, 1): 2} for k in (2, 3, 4)}


def test_taken_rows_keep_their_entries():
    x = np.array([[0.0, 2.0, 3.0], [0.0, 0.0, 0.0], [4.0, 0.0, 5.0]])
    row, at = np.nonzero(x)
    rows = Rows(3, np.array([0, 2, 2, 4]), at.astype(np.int32), x[row, at])
    for wanted in ([2, 0], [1], [], [0, 1, 2]):
        some = rows.take(np.array(wanted, int))
        assert (some.columns(np.arange(3)) == x[wanted]).all()


def test_all_rows_walk_as_one_by_one(monkeypatch):
    """Lopsided trees, one that is only a root, missing values and parts of the rows."""
    monkeypatch.setattr(sparse_rows, "WALKED", 16)
    feature = np.array([[0, -1, 1, -1, 2, -1, -1], [-1, -1, -1, -1, -1, -1, -1], [2, 1, -1, -1, -1, -1, -1]])
    left = np.array([[1, -1, 3, -1, 5, -1, -1], [-1] * 7, [1, 3, -1, -1, -1, -1, -1]])
    right = np.array([[2, -1, 4, -1, 6, -1, -1], [-1] * 7, [2, 4, -1, -1, -1, -1, -1]])
    threshold = np.random.default_rng(2).random((3, 7))
    x = np.random.default_rng(3).random((50, 3))
    x[7] = np.nan
    walk = sparse_rows.Walk(feature, threshold, left, right)
    assert walk.depth.tolist() == [3, 0, 2]
    got = np.full((3, len(x)), -1)
    for rows, t, at in walk.leaves(x):
        got[t, rows] = at
    for t in range(3):
        for i in range(len(x)):
            node = 0
            while feature[t, node] >= 0:
                node = (left if x[i, feature[t, node]] <= threshold[t, node] else right)[t, node]
            assert got[t, i] == node
