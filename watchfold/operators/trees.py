"""Histogram trees on Spark: several boosted ensembles or forests grown together on one binned table.

Every feature is binned once. The binned rows are stored in blocks; one Spark job per
level adds up, for all trees that are growing, the histograms of the nodes to be split:
map tasks add the rows of their blocks, the sums are shuffled by tree, and the tasks
that receive them choose the best split of each node. Only the chosen splits, one row
per node, come to the driver, which holds the model and nothing else.

A table of at most ``APART`` blocks needs no sums: there each member (and each ``PORTION``
of a forest) is grown by a task of its own, which runs the same loop on the blocks. Two
jobs a level are most of the time where a level is short work, and a level has up to ten.

Boosting uses softmax gradients of all classes at once. The folds of a cross-validation
are further members of the same jobs: a member leaves out the rows of its fold. Margins
are stored every ``SNAPSHOT`` rounds; between two snapshots a task applies the few
trees grown since. A lost task or executor is repeated from the stored blocks.
"""

from __future__ import annotations

import functools
import heapq
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchfold.operators.sparse import ROW, Rows, Walk, is_sparse, sparse
from watchfold.session import keep

BINS = 64
BLOCK = 4096
SNAPSHOT = 10
PORTION = 25
#: Blocks that a task of its own may hold: 1,048,576 rows, in small numbers: a byte per row and feature, two per entry.
APART = 256
#: Rows whose entries such a task works on at once.
STRETCH = 1 << 16
#: Columns of bins that such a task keeps.
COLUMNS = 256
#: Cells of a matrix of all bins, one byte each, that it may keep for a forest.
CELLS = 128 << 20
#: Numbers that it works on at once: the nodes of a level are summed and compared in groups of about so many.
STEP = 1 << 18
#: Bytes of histograms that one job adds up in a task; more nodes than that go on in further jobs.
HISTOGRAMS = 256 << 20
#: Bytes of them that a task which chooses splits holds.
SHUFFLED = 32 << 20

NODES = (
    "member int, tree int, output int, node int, feature int, threshold double, left_node int, right_node int, "
    "cover double, gain double, value array<double>"
)
BLOCKS = "n int, ids binary, y binary, fold binary, ptr binary, at binary, bin binary, margins binary"


@dataclass(frozen=True)
class Plan:
    """One ensemble: a member of a joint growth.

    ``held_out`` is the fold that it does not see (-1: none). ``leaves`` grows
    best-first up to that many leaves (0: no bound but the depth).
    """

    boosted: bool
    trees: int
    depth: int
    balanced: bool
    held_out: int = -1
    rate: float = 0.1
    rows: float = 0.8
    columns: float = 0.8
    least_weight: float = 1.0
    least_rows: int = 1
    shrink: float = 1.0
    leaves: int = 0


@dataclass(frozen=True)
class Bins:
    """Per used feature: its index, the number of bins, the bin of zero and the edges (x <= edge goes left)."""

    features: np.ndarray
    count: np.ndarray
    zero: np.ndarray
    edges: tuple[np.ndarray, ...]

    def of(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row pointers, places in ``features``, bins) of the entries whose bin is not that of zero."""
        place = np.minimum(np.searchsorted(self.features, rows.at), max(len(self.features) - 1, 0))
        known = self.features[place] == rows.at if len(self.features) else np.zeros(len(rows.at), bool)
        bins = np.zeros(len(rows.at), np.uint8)
        one = np.array([e[0] if len(e) == 1 else np.inf for e in self.edges] or [np.inf])
        bins[known] = rows.x[known] > one[place[known]]
        by = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[by], np.arange(len(self.features) + 1))
        for f in np.flatnonzero(self.count > 2):
            mine = by[ends[f] : ends[f + 1]]
            bins[mine] = np.searchsorted(self.edges[f], rows.x[mine], side="left")
        known &= bins != self.zero[place] if len(self.features) else False
        kept = np.bincount(rows.row[known], minlength=rows.n)
        return np.r_[0, np.cumsum(kept)], place[known].astype(np.int32), bins[known]


def fit_bins(rows: DataFrame) -> Bins:
    """Edges half-way between at most ``BINS`` values of each feature: all of them, or evenly spread quantiles.

    ``rows`` has the column ``features`` of type ``ROW``. One row per used feature comes back.
    """
    n = rows.count()
    cells = rows.select(F.explode(F.arrays_zip("features.at", "features.x")).alias("c"))
    probs = [i / (BINS - 2) for i in range(BINS - 1)]
    per = cells.groupBy(F.col("c.at").alias("at")).agg(
        F.percentile_approx("c.x", probs, 10_000).alias("values"), F.count(F.lit(1)).alias("n")
    )
    used, edges, zero = [], [], []
    for r in per.orderBy("at").collect():
        values = np.unique([*r["values"], *([0.0] if r["n"] < n else [])])
        if len(values) > 1:
            used.append(r["at"])
            edges.append((values[1:] + values[:-1]) / 2)
            zero.append(int(np.searchsorted(edges[-1], 0.0, side="left")))
    count = np.array([len(e) + 1 for e in edges], np.int64)
    return Bins(np.array(used, np.int64), count, np.array(zero, np.int64), tuple(edges))


@dataclass
class Tree:
    """A tree while it grows, by bins; node 0 is the root."""

    member: int
    number: int
    output: int
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    stats: list[np.ndarray | None] = field(default_factory=lambda: [None])
    value: list[float] | None = None

    def split(self, node: int, feature: int, cut: int, gain: float, left: np.ndarray, right: np.ndarray) -> None:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        for side, stats in ((self.left, left), (self.right, right)):
            side[node] = len(self.feature)
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(-1)
            self.right.append(-1)
            self.gain.append(0.0)
            self.stats.append(stats)
            self.depth.append(self.depth[node] + 1)

    def best_first(self, leaves: int) -> set[int]:
        """The nodes that growth by the largest gain splits within ``leaves`` leaves."""
        chosen: set[int] = set()
        heap = [(-self.gain[0], 0)] if self.feature[0] >= 0 else []
        while heap and len(chosen) < leaves - 1:
            _, node = heapq.heappop(heap)
            chosen.add(node)
            for child in (self.left[node], self.right[node]):
                if self.feature[child] >= 0:
                    heapq.heappush(heap, (-self.gain[child], child))
        return chosen

    def cut_back(self, chosen: set[int]) -> None:
        for node in range(len(self.feature)):
            if node not in chosen:
                self.feature[node] = self.left[node] = self.right[node] = -1
                self.gain[node] = 0.0

    def route(self, bins: "Columns") -> np.ndarray:
        """The node at which each row stands."""
        at = np.zeros(bins.n, np.int64)
        feature, cut, left, right = (np.array(v) for v in (self.feature, self.cut, self.left, self.right))
        moving = np.arange(bins.n)
        while len(moving):
            moving = moving[feature[at[moving]] >= 0]
            node = at[moving]
            goes = bins.get(moving, feature[node]) <= cut[node]
            at[moving] = np.where(goes, left[node], right[node])
        return at


class Columns:
    """The bins of the features that some trees use, as a matrix."""

    def __init__(self, block: "Block", bins: Bins, trees: list[Tree]):
        used = np.unique([f for t in trees for f in t.feature if f >= 0]).astype(np.int64)
        self.n, self.place = block.n, np.full(len(bins.features) + 1, -1)
        self.place[used] = np.arange(len(used))
        self.bins = np.repeat(bins.zero[used][None, :], block.n, axis=0) if len(used) else np.zeros((block.n, 1), int)
        to = self.place[block.at]
        hit = to >= 0
        self.bins[block.row[hit], to[hit]] = block.bin[hit]

    def get(self, rows: np.ndarray, features: np.ndarray) -> np.ndarray:
        return self.bins[rows, self.place[features]]


class Block:
    """Some binned rows with their margins (rows, boosted members, classes)."""

    def __init__(self, row: dict, classes: int, stored: bool = True):
        self.n = row["n"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.y = np.frombuffer(row["y"], np.int32)
        self.fold = np.frombuffer(row["fold"], np.int32)
        self.ptr = np.frombuffer(row["ptr"], np.int64)
        self.at = np.frombuffer(row["at"], np.int32)
        self.bin = np.frombuffer(row["bin"], np.uint8)
        if stored:
            self.margins = np.frombuffer(row["margins"], np.float64).reshape(self.n, -1, classes)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.ptr))

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return Rows(self.n, self.ptr, self.at, self.bin).entries(rows)


def _draw(ids: np.ndarray, *salt: int) -> np.ndarray:
    """A repeatable number in [0, 1) per id."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64)
        for s in (*salt, 0):
            z = (z ^ np.uint64(s & (1 << 63) - 1)) * np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) / (1 << 53)


@functools.lru_cache(maxsize=4096)
def _choose(width: int, size: int, salt: tuple[int, ...]) -> np.ndarray:
    """``size`` of ``width`` places, drawn repeatably, in order."""
    out = np.sort(np.random.default_rng(list(salt)).choice(width, size, replace=False))
    out.flags.writeable = False
    return out


#: How often a row is drawn into a bootstrap sample: the distribution function of Poisson(1).
_POISSON = np.cumsum(np.exp(-1.0) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320]))


@dataclass(frozen=True)
class Job:
    """What a task has to know to add up histograms."""

    plans: tuple[Plan, ...]
    bins: Bins
    classes: int
    weights: np.ndarray  # (members, classes)
    seed: int
    round: int
    pending: tuple[Tree, ...]
    trees: tuple[Tree, ...]
    frontier: dict[int, list[int]]  # place in ``trees`` -> nodes

    def allowed(self, tree: Tree, node: int) -> np.ndarray:
        """Places of the features a node may split on: drawn per tree when boosting, per node in a forest."""
        plan, width = self.plans[tree.member], len(self.bins.features)
        salt = [self.seed, tree.member, tree.number, tree.output + 1]
        if plan.boosted:
            size = max(1, int(plan.columns * width))
        else:
            size, salt = max(1, int(np.sqrt(width))), [*salt, node]
        return _choose(width, min(size, width), tuple(salt))

    def margins(self, block: Block, columns: Columns) -> np.ndarray:
        out = block.margins.copy()
        place = boosted_places(self.plans)
        for t in self.pending:
            out[:, place[t.member], t.output] += np.array(t.value)[t.route(columns)]
        return out

    def statistics(self, block: Block, margins: np.ndarray) -> Iterator[tuple[int, Tree, np.ndarray, np.ndarray]]:
        """Per growing tree: its place, the rows that count and their statistics, one column each."""
        place, known = boosted_places(self.plans), {}
        for i, tree in enumerate(self.trees):
            if not self.frontier.get(i):
                continue
            plan = self.plans[tree.member]
            if tree.member not in known:
                seen = block.fold != plan.held_out
                weight = self.weights[tree.member][block.y]
                if plan.boosted:
                    seen &= _draw(block.ids, self.seed, self.round) < plan.rows
                    z = margins[:, place[tree.member]]
                    p = np.exp(z - z.max(axis=1, keepdims=True))
                    known[tree.member] = seen, weight, p / p.sum(axis=1, keepdims=True)
                else:
                    known[tree.member] = seen, weight, None
            seen, weight, p = known[tree.member]
            if plan.boosted:
                share = p[:, tree.output]
                g = weight * (share - (block.y == tree.output))
                h = weight * np.maximum(2.0 * share * (1.0 - share), 1e-16)
                rows = np.flatnonzero(seen)
                yield i, tree, rows, np.stack([g, h, np.ones(block.n)], axis=1)[rows]
            else:
                times = np.searchsorted(_POISSON, _draw(block.ids, self.seed, tree.number, 7))
                rows = np.flatnonzero(seen & (times > 0))
                stats = np.zeros((len(rows), self.classes + 1))
                stats[np.arange(len(rows)), block.y[rows]] = (weight * times)[rows]
                stats[:, -1] = times[rows]
                yield i, tree, rows, stats

    def histograms(self, block: Block) -> Iterator[tuple[int, int, np.ndarray]]:
        """(place of the tree, node, statistics by (total and then bins of the allowed features))."""
        columns = Columns(block, self.bins, [*self.pending, *self.trees])
        margins = self.margins(block, columns)
        for i, tree, rows, stats in self.statistics(block, margins):
            nodes = np.array(self.frontier[i])
            node = tree.route(columns)[rows]
            order = np.full(len(tree.feature), -1)
            order[nodes] = np.arange(len(nodes))
            inside = order[node] >= 0
            rows, stats, node = rows[inside], stats[inside], order[node[inside]]
            groups = [np.arange(len(nodes))] if self.plans[tree.member].boosted else np.arange(len(nodes))[:, None]
            by = np.argsort(node, kind="stable")
            ends = np.searchsorted(node[by], np.arange(len(nodes) + 1))
            for group in groups:
                mine = by[ends[group[0]] : ends[group[-1] + 1]]
                if not len(mine):
                    continue
                allowed = self.allowed(tree, int(nodes[group[0]]))
                start = np.full(len(self.bins.features), -1)
                start[allowed] = np.cumsum(self.bins.count[allowed]) - self.bins.count[allowed]
                size = int(self.bins.count[allowed].sum())
                place, entry = block.entries(rows[mine])
                hit = start[block.at[entry]] >= 0
                place, entry = place[hit], entry[hit]
                at = (node[mine][place] - group[0]) * size + start[block.at[entry]] + block.bin[entry]
                values = stats[mine]
                out = np.empty((len(group), values.shape[1], size + 1))
                for c in range(values.shape[1]):
                    out[:, c, 0] = np.bincount(node[mine] - group[0], values[:, c], len(group))
                    out[:, c, 1:] = np.bincount(at, values[place, c], len(group) * size).reshape(len(group), size)
                for j, k in enumerate(group):
                    yield i, int(nodes[k]), out[j]

    def best(self, i: int, node: int, sums: np.ndarray) -> dict[str, object]:
        """The best split of a node; feature -1 if none is allowed and gains."""
        tree = self.trees[i]
        plan, allowed = self.plans[tree.member], self.allowed(tree, node)
        total, hist = sums[:, 0], sums[:, 1:].copy()
        none = {"tree": i, "node": node, "feature": -1, "cut": 0, "gain": 0.0, "total": total, "left": [], "right": []}
        if not len(allowed):
            return none
        count = self.bins.count[allowed]
        start = np.cumsum(count) - count
        hist[:, start + self.bins.zero[allowed]] += total[:, None] - np.add.reduceat(hist, start, axis=1)
        run = np.cumsum(hist, axis=1)
        left = run - np.repeat(run[:, start] - hist[:, start], count, axis=1)
        right = total[:, None] - left
        fine = (left[-1] >= plan.least_rows) & (right[-1] >= plan.least_rows)
        fine[start + count - 1] = False
        if plan.boosted:
            fine &= (left[1] >= plan.least_weight) & (right[1] >= plan.least_weight)
            score = lambda s: s[0] ** 2 / np.maximum(s[1] + plan.shrink, 1e-12)
        else:
            score = lambda s: (s[:-1] ** 2).sum(axis=0) / np.maximum(s[:-1].sum(axis=0), 1e-12)
        gain = np.where(fine, score(left) + score(right) - score(total), -np.inf)
        top = gain.max()
        if not top > 1e-9:
            return none
        # Equal gains may differ by the order of the sums, or as differences of them.
        pick = int(np.argmax(gain >= top - 1e-9 * abs(top) - 1e-12 * score(total[:, None])[0]))
        f = int(np.searchsorted(start, pick, side="right")) - 1
        return none | {
            "feature": int(allowed[f]), "cut": pick - int(start[f]), "gain": float(gain[pick]),
            "left": left[:, pick], "right": right[:, pick],
        }


def boosted_places(plans: tuple[Plan, ...]) -> dict[int, int]:
    """Where the margins of each boosted member stand."""
    return {m: i for i, m in enumerate(m for m, p in enumerate(plans) if p.boosted)}


def _tables(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches of a partition, joined and cut into tables of ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while n + batch.num_rows >= rows:
            held.append(batch.slice(0, rows - n))
            yield pa.Table.from_batches(held).combine_chunks()
            batch, held, n = batch.slice(rows - n), [], 0
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _blocks_of(rows: DataFrame, n: int, bins: Bins, margins: int) -> DataFrame:
    """Binned blocks of ``n`` rows (event_id, features, class_code, fold), margins all zero."""

    def pack(batches):
        for part in _tables(batches, BLOCK):
            size = part.num_rows
            ptr, place, value = bins.of(Rows.of(part["features"].chunk(0)))
            numbers = {c: part[c].to_numpy() for c in ("event_id", "class_code", "fold")}
            row = [
                numbers["event_id"].astype(np.int64).tobytes(), numbers["class_code"].astype(np.int32).tobytes(),
                numbers["fold"].astype(np.int32).tobytes(), ptr.astype(np.int64).tobytes(), place.tobytes(),
                value.tobytes(), np.zeros(size * margins).tobytes(),
            ]
            arrays = [pa.array([size], pa.int32()), *[pa.array([v], pa.binary()) for v in row]]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in BLOCKS.split(", ")])

    # However the rows lie, they make no more blocks than they fill.
    some = rows.select("event_id", "features", "class_code", "fold").coalesce(max(1, -(-n // BLOCK)))
    return keep(some.mapInArrow(pack, BLOCKS), "binned")


def _advance(blocks: DataFrame, job: Job) -> DataFrame:
    """The blocks with the pending trees added to their margins, stored."""

    def move(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, job.classes)
                row["margins"] = job.margins(block, Columns(block, job.bins, list(job.pending))).tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=batch.schema)

    return keep(blocks.mapInArrow(move, BLOCKS), "margins")


def _splits(blocks: DataFrame, job: Job) -> list[dict]:
    """The best splits of all nodes of the frontier, in jobs of bounded size."""
    width = int(job.bins.count.sum()) + 1
    channels = 3 if job.plans[job.trees[0].member].boosted else job.classes + 1
    most = max(1, HISTOGRAMS // (8 * width * channels))
    wanted = [(i, node) for i, nodes in job.frontier.items() for node in nodes]
    out: list[dict] = []
    for at in range(0, len(wanted), most):
        some: dict[int, list[int]] = {}
        for i, node in wanted[at : at + most]:
            some.setdefault(i, []).append(node)
        out += _split_job(blocks, replace(job, frontier=some))
    return out


def _split_job(blocks: DataFrame, job: Job) -> list[dict]:
    def summed(items: Iterator[tuple[int, int, np.ndarray]]) -> dict[tuple[int, int], np.ndarray]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for i, node, h in items:
            if (i, node) in sums:
                sums[i, node] += h
            else:
                sums[i, node] = np.array(h)
        return sums

    def add(batches):
        found = (item for b in batches for row in b.to_pylist() for item in job.histograms(Block(row, job.classes)))
        sums = list(summed(found).items())
        for at in range(0, len(sums), 64):
            keys, blobs = zip(*sums[at : at + 64])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([len(b) for b in blobs], pa.int32()), pa.array([b.tobytes() for b in blobs], pa.binary()),
                ],
                names=["tree", "node", "rows", "sums"],
            )

    def choose(batches):
        found = (
            (r["tree"], r["node"], np.frombuffer(r["sums"]).reshape(r["rows"], -1))
            for b in batches for r in b.to_pylist()
        )
        made = [job.best(i, node, sums) for (i, node), sums in sorted(summed(found).items())]
        if made:
            yield pa.RecordBatch.from_pylist(
                [{k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in m.items()} for m in made],
                schema=pa.schema(
                    [("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("cut", pa.int32()),
                     ("gain", pa.float64())] + [(c, pa.list_(pa.float64())) for c in ("total", "left", "right")]
                ),
            )

    width = 8 * (int(job.bins.count.sum()) + 1) * (3 if job.plans[job.trees[0].member].boosted else job.classes + 1)
    tasks = 1 + width * sum(map(len, job.frontier.values())) // SHUFFLED
    partial = blocks.mapInArrow(add, "tree int, node int, rows int, sums binary").repartition(tasks, "tree", "node")
    schema = "tree int, node int, feature int, cut int, gain double"
    schema += ", total array<double>, left array<double>, right array<double>"
    made = partial.mapInArrow(choose, schema).collect()
    return sorted((r.asDict() for r in made), key=lambda s: (s["tree"], s["node"]))


def _grow(splits: Callable[[Job], list[dict]], job: Job) -> tuple[Tree, ...]:
    """All trees of a round, or all trees of a forest, level by level."""
    trees = job.trees
    frontier = {i: [0] for i in range(len(trees))}
    while frontier:
        open_now: dict[int, list[int]] = {}
        for s in splits(replace(job, frontier=frontier)):
            tree, node = trees[s["tree"]], s["node"]
            plan = job.plans[tree.member]
            tree.stats[node] = np.array(s["total"])
            if s["feature"] < 0:
                continue
            tree.split(node, s["feature"], s["cut"], s["gain"], np.array(s["left"]), np.array(s["right"]))
            for child in (tree.left[node], tree.right[node]):
                stats = tree.stats[child]
                enough = stats[-1] >= 2 * plan.least_rows
                if plan.boosted:
                    enough &= stats[1] >= 2 * plan.least_weight
                else:
                    enough &= np.count_nonzero(stats[:-1]) > 1
                if tree.depth[child] < plan.depth and enough:
                    open_now.setdefault(s["tree"], []).append(child)
        frontier = {}
        for i, nodes in open_now.items():
            leaves = job.plans[trees[i].member].leaves
            if leaves:
                # A split that is not reached now is not reached with more candidates either.
                chosen = trees[i].best_first(leaves)
                reached = {c for p in chosen for c in (trees[i].left[p], trees[i].right[p])}
                nodes = [n for n in nodes if n in reached]
            if nodes:
                frontier[i] = sorted(nodes)
    for tree in trees:
        plan = job.plans[tree.member]
        if plan.leaves:
            tree.cut_back(tree.best_first(plan.leaves))
        if plan.boosted:
            zero = np.zeros(3)
            stats = [zero if s is None else s for s in tree.stats]
            tree.value = [float(-plan.rate * s[0] / max(s[1] + plan.shrink, 1e-12)) for s in stats]
    return trees


def fit_trees(rows: DataFrame, plans: list[Plan], classes: int, seed: int) -> DataFrame:
    """Node table (``NODES``) of all members, grown together.

    ``rows``: event_id long, features (``ROW`` or array), class_code, fold. All plans are
    boosted, or none is; boosted ones have the same number of rounds.
    """
    spark = rows.sparkSession
    ready = rows.select(
        "event_id", (F.col("features") if is_sparse(rows) else sparse(F.col("features"))).alias("features"),
        F.col("class_code").cast("int").alias("class_code"), "fold",
    )
    bins = fit_bins(ready)
    members = tuple(plans)
    # One row per fold and class.
    counts = ready.groupBy("fold", "class_code").count().collect()
    weights = np.ones((len(plans), classes))
    for m, plan in enumerate(plans):
        if plan.balanced:
            n = np.zeros(classes)
            for r in counts:
                if r["fold"] != plan.held_out:
                    n[r["class_code"]] += r["count"]
            weights[m] = n.sum() / max(np.count_nonzero(n), 1) / np.maximum(n, 1)
    n = sum(r["count"] for r in counts)
    apart = n <= APART * BLOCK
    blocks = _blocks_of(ready, n, bins, 0 if apart else sum(p.boosted for p in plans) * classes)
    job = Job(members, bins, classes, weights, seed, 0, (), (), {})
    if apart:
        return keep(_grow_apart(blocks, job), "tree-nodes")
    state = [blocks]

    def advance(now: Job) -> None:
        state[0] = _advance(state[0], now)

    units = [(m, 0, plan.trees) for m, plan in enumerate(plans)]
    grown = _grow_units(lambda now: _splits(state[0], now), advance, job, units, SNAPSHOT)
    return keep(spark.createDataFrame(_node_rows(grown, job).to_pandas(), NODES), "tree-nodes")


def _grow_units(
    splits: Callable[[Job], list[dict]],
    advance: Callable[[Job], None],
    job: Job,
    units: list[tuple[int, int, int]],
    snapshot: int,
) -> list[Tree]:
    """The trees ``first`` up to ``stop`` of each (member, first, stop); boosted members are grown from round 0."""
    grown: list[Tree] = []
    if not job.plans[units[0][0]].boosted:
        trees = tuple(Tree(m, t, -1) for m, first, stop in units for t in range(first, stop))
        return list(_grow(splits, replace(job, trees=trees)))
    pending: tuple[Tree, ...] = ()
    for r in range(units[0][2]):
        trees = tuple(Tree(m, r, k) for m, _, _ in units for k in range(job.classes))
        trees = _grow(splits, replace(job, round=r, pending=pending, trees=trees))
        grown += trees
        pending += trees
        if (r + 1) % snapshot == 0:
            advance(replace(job, pending=pending))
            pending = ()
    return grown


def _picked(
    items: list[tuple[int, int]],
    gain: np.ndarray,
    whole: np.ndarray,
    total: np.ndarray,
    split_at: Callable[[int, int], tuple[int, int, np.ndarray]],
) -> list[dict]:
    """Per (tree, node) its best split from a row of gains, as ``Job.best`` chooses it."""
    top = gain.max(axis=1)
    gains = top > 1e-9
    least = np.where(gains, top - 1e-9 * np.abs(top) - 1e-12 * whole, np.inf)
    picks = np.argmax(gain >= least[:, None], axis=1)
    out = []
    for k, (i, node) in enumerate(items):
        one = {"tree": i, "node": node, "feature": -1, "cut": 0, "gain": 0.0, "total": total[k], "left": [], "right": []}
        if gains[k]:
            feature, cut, left = split_at(k, int(picks[k]))
            one |= {"feature": feature, "cut": cut, "gain": float(gain[k, picks[k]]), "left": left, "right": total[k] - left}
        out.append(one)
    return out


class Held:
    """All rows in one task, which grows the trees of one member on them.

    Between two levels it keeps the rows of the open nodes and, when boosting, their
    sums: of two children the one with fewer rows is added up, the other has the rest of
    their parent's. Many nodes of a level, of all trees, are added up and compared at once:
    most are so small that one by one their calls would cost more than their rows. The
    sums of boosted trees cover all features, of which each tree may use some.
    """

    def __init__(self, parts: list[dict] | deque[dict], job: Job):
        self.bins, self.width = job.bins, int(job.bins.count.sum())
        self.first = np.cumsum(job.bins.count) - job.bins.count
        n = sum(p["n"] for p in parts)
        self.narrow = 0 < n * len(job.bins.features) <= CELLS
        kind = np.uint16 if self.width < 1 << 16 else np.int32
        # Each part is turned into small numbers and, if it came in a queue, let go.
        waiting = deque(parts)
        if isinstance(parts, deque):
            parts.clear()
        held: dict[str, list] = {c: [] for c in ("ids", "y", "fold", "at", "bin")}
        sizes, cells, seen = [], [], 0
        self.matrix = np.empty((n, len(job.bins.features)), np.uint8) if self.narrow else None
        while waiting:
            part = waiting.popleft()
            size, at, bins = (np.frombuffer(part[c], k) for c, k in (("ptr", np.int64), ("at", np.int32), ("bin", np.uint8)))
            sizes.append(np.diff(size))
            cells.append((self.first[at] + bins).astype(kind) if len(at) else np.zeros(0, kind))
            if self.narrow:
                mine = self.matrix[seen : seen + part["n"]]
                mine[:] = job.bins.zero
                mine[np.repeat(np.arange(part["n"]), sizes[-1]), at] = bins
            seen += part["n"]
            for c in ("ids", "y", "fold") if self.narrow else held:
                held[c].append(part[c])
        ptr = np.r_[0, np.cumsum(np.concatenate(sizes))] if sizes else np.zeros(1)
        self.block = Block(
            {"n": n, "ptr": ptr.astype(np.int64).tobytes(), "margins": b"", **{c: b"".join(v) for c, v in held.items()}},
            job.classes, stored=False,
        )
        self.margins = np.zeros((n, 1, job.classes))
        self.cells = np.concatenate(cells) if cells else np.zeros(0, kind)
        del held, cells
        if not self.narrow:
            self.by = np.argsort(self.block.at, kind="stable")
            self.ends = np.searchsorted(self.block.at[self.by], np.arange(len(job.bins.features) + 1))
        self.columns: dict[int, np.ndarray] = {}
        self.rows: dict[tuple[int, int], np.ndarray] = {}
        self.sums: dict[tuple[int, int], np.ndarray] = {}
        self.stats: dict[int, np.ndarray] = {}
        self.open: dict[int, list[int]] = {}

    def column(self, feature: int) -> np.ndarray:
        """The bin of one feature in every row."""
        if self.narrow:
            return self.matrix[:, feature]
        if feature not in self.columns:
            if len(self.columns) >= COLUMNS:
                self.columns.clear()
            mine = self.by[self.ends[feature] : self.ends[feature + 1]]
            out = np.full(self.block.n, self.bins.zero[feature], np.uint8)
            out[self.block.row[mine]] = self.block.bin[mine]
            self.columns[feature] = out
        return self.columns[feature]

    def part(self, i: int, tree: Tree, node: int) -> None:
        """Deal the rows of a split node to its children."""
        left, right = tree.left[node], tree.right[node]
        if (i, node) not in self.parted:
            self.parted.add((i, node))
            rows = self.rows[i, node]
            goes = self.column(tree.feature[node])[rows] <= tree.cut[node]
            self.rows[i, left], self.rows[i, right] = rows[goes], rows[~goes]
            if self.spent:
                del self.rows[i, node]

    def begin(self, job: Job) -> None:
        """Rows and statistics of the trees that grow now."""
        self.rows, self.sums, self.stats, self.open = {}, {}, {}, {}
        # A tree that is not cut back needs the rows of its leaves only.
        self.spent, self.parted = not any(p.leaves for p in job.plans), set()
        places = max(1, sum(p.boosted for p in job.plans))
        margins = np.broadcast_to(self.margins, (self.block.n, places, job.classes))
        roots = {}
        for i, tree, rows, stats in job.statistics(self.block, margins):
            if job.plans[tree.member].boosted:
                if tree.member not in roots:
                    # Rows that were not drawn are dealt too: the next rounds need their margins.
                    known = np.flatnonzero(self.block.fold != job.plans[tree.member].held_out).astype(np.int32)
                    roots[tree.member] = known, rows, self.gathered(rows)
                self.rows[i, 0] = roots[tree.member][0]
                self.stats[i] = np.zeros((3, self.block.n))
                self.stats[i][:, rows] = stats.T
                self.sums[i, 0] = self.added([(i, rows)], roots[tree.member][2])[0]
            else:
                self.rows[i, 0] = rows.astype(np.int32)
                self.stats[i] = np.zeros(self.block.n)
                self.stats[i][rows] = stats[:, -1]

    def gathered(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries per row, and their cells."""
        start = self.block.ptr[rows]
        size = self.block.ptr[rows + 1] - start
        out = np.empty(int(size.sum()), self.cells.dtype)
        at = 0
        for k in range(0, len(rows), STRETCH):
            some = size[k : k + STRETCH]
            ends = np.cumsum(some)
            entry = np.repeat(start[k : k + STRETCH] - ends + some, some)
            entry += np.arange(len(entry))
            out[at : at + len(entry)] = self.cells[entry]
            at += len(entry)
        return size, out

    def added(self, parts: list[tuple[int, np.ndarray]], gathered: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Per (tree, rows that were drawn): statistics by (total, and per bin of all features those of it and lower ones)."""
        n, rows = len(parts), np.concatenate([rows for _, rows in parts])
        of = np.repeat(np.arange(n), [len(rows) for _, rows in parts])
        out = np.zeros((n, 3, self.width + 1))
        out[:, 2, 0] = np.bincount(of, minlength=n)
        both = [np.concatenate([self.stats[i][c][rows] for i, rows in parts]) for c in range(2)]
        for c, values in enumerate(both):
            out[:, c, 0] = np.bincount(of, values, n)
        at = 0
        for k in range(0, len(rows), STRETCH):
            mine = slice(k, k + STRETCH)
            if gathered:
                size = gathered[0][mine]
                cells = gathered[1][at : at + int(size.sum())]
                at += len(cells)
            else:
                size, cells = self.gathered(rows[mine])
            cells = cells.astype(np.int64)
            if n > 1:
                cells += np.repeat(of[mine] * self.width, size)
            for c, values in enumerate(both):
                out[:, c, 1:] += np.bincount(cells, np.repeat(values[mine], size), n * self.width).reshape(n, self.width)
            out[:, 2, 1:] += np.bincount(cells, minlength=n * self.width).reshape(n, self.width)
        if self.width:
            hist, first, count = out[:, :, 1:], self.first, self.bins.count
            hist[:, :, first + self.bins.zero] += out[:, :, :1] - np.add.reduceat(hist, first, axis=2)
            before = hist[:, :, first]
            np.cumsum(hist, axis=2, out=hist)
            hist -= np.repeat(hist[:, :, first] - before, count, axis=2)
        return out

    def descend(self, job: Job, frontier: dict[int, list[int]]) -> None:
        """Rows, and sums when boosting, of the nodes that are open now."""
        todo: list[tuple[int, int, int, np.ndarray, set[int]]] = []
        held, entries = [], 0
        for i, nodes in frontier.items():
            tree, opened = job.trees[i], set(nodes)
            for parent in self.open[i]:
                sums = self.sums.pop((i, parent), None)
                children = (tree.left[parent], tree.right[parent])
                wanted = opened.intersection(c for c in children if c >= 0)
                if not wanted:
                    continue
                self.part(i, tree, parent)
                if sums is None:
                    continue
                small, large = sorted(children, key=lambda c: len(self.rows[i, c]))
                rows = self.rows[i, small]
                rows = rows[self.stats[i][2][rows] > 0]
                held.append((i, rows))
                todo.append((i, small, large, sums, wanted))
                entries += len(rows) * max(1, len(self.cells) // max(self.block.n, 1)) + self.width
                if entries >= STEP:
                    self.settle(held, todo)
                    held, todo, entries = [], [], 0
        if todo:
            self.settle(held, todo)

    def settle(self, held: list[tuple[int, np.ndarray]], todo: list[tuple[int, int, int, np.ndarray, set[int]]]) -> None:
        """Sums of the smaller children, and what their parents have beside them."""
        for less, (i, small, large, sums, wanted) in zip(self.added(held), todo, strict=True):
            if small in wanted:
                self.sums[i, small] = less
            if large in wanted:
                self.sums[i, large] = sums - less

    def counted(self, job: Job, i: int, node: int) -> np.ndarray:
        """Statistics of a node of a forest by (total and then bins of the features it may split on)."""
        tree, block, classes = job.trees[i], self.block, job.classes
        allowed, rows = job.allowed(tree, node), self.rows[i, node]
        start = np.full(len(self.bins.features) + 1, -1)
        start[allowed] = np.cumsum(self.bins.count[allowed]) - self.bins.count[allowed]
        size = int(self.bins.count[allowed].sum())
        times, y = self.stats[i][rows], block.y[rows]
        place, entry = block.entries(rows)
        at = start[block.at[entry]]
        hit = at >= 0
        place, at = place[hit], at[hit] + block.bin[entry[hit]]
        out = np.empty((classes + 1, size + 1))
        out[:-1, 0] = np.bincount(y, times, classes)
        out[:-1, 1:] = np.bincount(y[place] * size + at, times[place], classes * size).reshape(classes, size)
        out[-1] = out[:-1].sum(axis=0)
        out[:-1] *= job.weights[tree.member][:, None]
        return out

    def best_boosted(self, job: Job, items: list[tuple[int, int]], usable: dict[int, np.ndarray]) -> list[dict]:
        """The best splits of some nodes; ``usable`` marks the cells that each tree may cut after."""
        plan = job.plans[job.trees[items[0][0]].member]
        sums = np.stack([self.sums[k] for k in items])
        total, (g, h, n) = sums[:, :, :1], np.moveaxis(sums[:, :, 1:], 1, 0)
        h_right, n_right = total[:, 1] - h, total[:, 2] - n
        fine = np.stack([usable[i] for i, _ in items])
        fine &= (n >= plan.least_rows) & (n_right >= plan.least_rows)
        fine &= (h >= plan.least_weight) & (h_right >= plan.least_weight)
        gain = g * g / np.maximum(h + plan.shrink, 1e-12)
        gain += (total[:, 0] - g) ** 2 / np.maximum(h_right + plan.shrink, 1e-12)
        whole = total[:, 0] ** 2 / np.maximum(total[:, 1] + plan.shrink, 1e-12)
        gain -= whole
        gain[~fine] = -np.inf
        return _picked(items, gain, whole[:, 0], total[:, :, 0], lambda k, cell: self.split_at(sums[k], cell))

    def split_at(self, sums: np.ndarray, cell: int) -> tuple[int, int, np.ndarray]:
        f = int(np.searchsorted(self.first, cell, side="right")) - 1
        return f, cell - int(self.first[f]), sums[:, 1 + cell]

    def best_voted(self, job: Job, items: list[tuple[int, int]]) -> list[dict]:
        """The best splits of some nodes of a forest, from the matrix of bins."""
        classes, deep, n = job.classes, int(self.bins.count.max()), len(items)
        tree = job.trees[items[0][0]]
        plan, weight = job.plans[tree.member], job.weights[tree.member]
        allowed = np.stack([job.allowed(job.trees[i], node) for i, node in items])
        each = [self.rows[k] for k in items]
        rows, of = np.concatenate(each), np.repeat(np.arange(n), [len(r) for r in each])
        times = np.concatenate([self.stats[i][r] for (i, _), r in zip(items, each, strict=True)])
        k = allowed.shape[1]
        at = (of[:, None] * k + np.arange(k)) * deep + self.matrix[rows[:, None], allowed[of]]
        at += self.block.y[rows][:, None] * (n * k * deep)
        left = np.bincount(at.ravel(), np.repeat(times, k), n * k * deep * classes).reshape(classes, n, k, deep)
        total = left[:, :, 0].sum(axis=2)
        left = np.cumsum(left, axis=3).reshape(classes, n, k * deep)
        few, many = left.sum(axis=0), total.sum(axis=0)[:, None]
        fine = (few >= plan.least_rows) & (many - few >= plan.least_rows)
        fine &= (np.arange(deep) < self.bins.count[allowed][:, :, None] - 1).reshape(n, -1)
        left *= weight[:, None, None]
        total = total * weight[:, None]
        score = lambda s: np.square(s).sum(axis=0) / np.maximum(s.sum(axis=0), 1e-12)
        whole = score(total)
        gain = score(left) + score(total[:, :, None] - left) - whole[:, None]
        gain[~fine] = -np.inf

        def split_at(j: int, cell: int) -> tuple[int, int, np.ndarray]:
            return int(allowed[j, cell // deep]), cell % deep, np.append(left[:, j, cell], few[j, cell])

        return _picked(items, gain, whole, np.hstack([total.T, many]), split_at)

    def splits(self, job: Job) -> list[dict]:
        if any(0 in nodes for nodes in job.frontier.values()):
            self.begin(job)
        self.descend(job, {i: nodes for i, nodes in job.frontier.items() if nodes != [0]})
        self.open = dict(job.frontier)
        items = [(i, node) for i, nodes in job.frontier.items() for node in nodes]
        boosted = job.plans[job.trees[items[0][0]].member].boosted
        if not self.width or not (boosted or self.narrow):
            sums = (self.sums.get(k) if boosted else self.counted(job, *k) for k in items)
            return sorted((job.best(*k, s) for k, s in zip(items, sums)), key=lambda s: (s["tree"], s["node"]))
        found: list[dict] = []
        if boosted:
            usable = {i: self.usable(job, job.trees[i]) for i in job.frontier}
            step = max(1, STEP // 8 // self.width)
            for at in range(0, len(items), step):
                found += self.best_boosted(job, items[at : at + step], usable)
        else:
            held, cells = [], 0
            for k in items:
                held.append(k)
                cells += int(np.sqrt(len(self.bins.features))) * (len(self.rows[k]) + int(self.bins.count.max()) * job.classes)
                if cells >= STEP:
                    found += self.best_voted(job, held)
                    held, cells = [], 0
            if held:
                found += self.best_voted(job, held)
        return sorted(found, key=lambda s: (s["tree"], s["node"]))

    def usable(self, job: Job, tree: Tree) -> np.ndarray:
        """The cells that a boosted tree may cut after: all but the last of each feature that it may use."""
        may = np.zeros(len(self.bins.features), bool)
        may[job.allowed(tree, 0)] = True
        out = np.repeat(may, self.bins.count)
        out[self.first + self.bins.count - 1] = False
        return out

    def advance(self, job: Job) -> None:
        """Add the trees that have just been grown to the margins."""
        for i, tree in enumerate(job.pending):
            todo = [0]
            while todo:
                node = todo.pop()
                if tree.feature[node] < 0:
                    self.margins[self.rows[i, node], 0, tree.output] += tree.value[node]
                else:
                    self.part(i, tree, node)
                    todo += [tree.left[node], tree.right[node]]


def _grow_apart(blocks: DataFrame, job: Job) -> DataFrame:
    """Node table from few blocks: one task per member, or portion of a forest."""
    units = []
    for m, plan in enumerate(job.plans):
        step = plan.trees if plan.boosted else PORTION
        units += [(m, at, min(at + step, plan.trees)) for at in range(0, plan.trees, step)]
    units.sort(key=lambda u: -job.plans[u[0]].depth)  # the longest tasks first

    def grow(batches):
        parts: dict[int, deque[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                parts.setdefault(row["unit"], deque()).append(row)
        for unit in sorted(parts):
            held = Held(parts.pop(unit), job)
            yield _node_rows(_grow_units(held.splits, held.advance, job, [units[unit]], 1), job)

    dealt = blocks.withColumn("unit", F.explode(F.sequence(F.lit(0), F.lit(len(units) - 1))))
    return dealt.repartitionByRange(len(units), "unit").mapInArrow(grow, NODES)


def _node_rows(trees: list[Tree], job: Job) -> pa.RecordBatch:
    rows = []
    for t in trees:
        boosted = job.plans[t.member].boosted
        todo = [0]
        while todo:
            node = todo.pop()
            f, stats = t.feature[node], t.stats[node]
            if boosted:
                cover, value = 0.0 if stats is None else stats[-1], [t.value[node]]
            else:
                weight = np.zeros(job.classes) if stats is None else stats[:-1]
                cover, value = weight.sum(), (weight / max(weight.sum(), 1e-300)).tolist()
            place = int(job.bins.features[f]) if f >= 0 else -1
            cut = float(job.bins.edges[f][t.cut[node]]) if f >= 0 else 0.0
            rows.append((t.member, t.number, t.output, node, place, cut, t.left[node], t.right[node], float(cover), t.gain[node], value))
            if f >= 0:
                todo += [t.left[node], t.right[node]]
    kinds = {"int": pa.int32(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
    fields = [c.split() for c in NODES.split(", ")]
    columns = [pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])


class Ensemble:
    """The node table of one member as padded arrays, for scoring."""

    def __init__(self, nodes: pd.DataFrame, boosted: bool, classes: int):
        nodes = nodes.sort_values(["tree", "output", "node"])
        keys = pd.MultiIndex.from_frame(nodes[["tree", "output"]])
        group = pd.factorize(keys)[0]
        shape = (group.max() + 1 if len(group) else 0, int(nodes["node"].max()) + 1 if len(nodes) else 1)
        self.boosted, self.classes = boosted, classes
        self.used = np.unique(nodes.loc[nodes["feature"] >= 0, "feature"].to_numpy()).astype(np.int64)
        col = nodes["node"].to_numpy()
        feature = np.full(shape, -1, np.int32)
        threshold, left, right = np.zeros(shape), np.zeros(shape, np.int32), np.zeros(shape, np.int32)
        inner = nodes["feature"].to_numpy() >= 0
        at = group[inner], col[inner]
        feature[at] = np.searchsorted(self.used, nodes["feature"].to_numpy()[inner])
        threshold[at] = nodes["threshold"].to_numpy()[inner]
        left[at] = nodes["left_node"].to_numpy()[inner]
        right[at] = nodes["right_node"].to_numpy()[inner]
        self.walk = Walk(feature, threshold, left, right)
        self.value = np.zeros((*shape, 1 if boosted else classes))
        sizes = nodes["value"].map(len).to_numpy() if len(nodes) else np.zeros(0, np.int64)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        values = np.concatenate(nodes["value"].to_numpy()) if len(nodes) else np.zeros(0)
        self.value[np.repeat(group, sizes), np.repeat(col, sizes), place] = values
        first = ~pd.Series(group).duplicated().to_numpy() if len(group) else np.zeros(0, bool)
        self.output = nodes["output"].to_numpy()[first]

    def outputs(self, rows: Rows) -> np.ndarray:
        """Margins per class of a boosted ensemble, mean class shares of a forest."""
        x = rows.columns(self.used)
        if not x.shape[1]:
            x = np.zeros((rows.n, 1))
        out = np.zeros((rows.n, self.classes))
        for part, t, at in self.walk.leaves(x):
            if self.boosted:
                out[part, self.output[t]] += self.value[t][at, 0]
            else:
                out[part] += self.value[t][at]
        return out if self.boosted or not len(self.output) else out / len(self.output)


def ensemble_of(nodes: DataFrame, boosted: bool, classes: int) -> Ensemble:
    """The node table of one member, fetched as Arrow whatever the session's settings: what a scorer reads, values of leaves only."""
    ends = F.when(F.col("feature") < 0, F.col("value")).otherwise(F.array().cast("array<double>")).alias("value")
    kept = nodes.select("tree", "output", "node", "feature", "threshold", "left_node", "right_node", ends)
    return Ensemble(kept.toArrow().to_pandas(self_destruct=True), boosted, classes)


__all__ = ["NODES", "ROW", "Ensemble", "Plan", "ensemble_of", "fit_bins", "fit_trees"]
