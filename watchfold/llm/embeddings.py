"""Near copies among embeddings: hierarchical navigable small-world graphs per shard.

Vectors are compared within a label (and a number of dimensions). Equal vectors are one
node with a count. A label's nodes are dealt into shards of about ``SHARD`` by hash; a
graph is built per shard, and every block of vectors is searched in every shard of its
label. Layers above the lowest hold ever fewer nodes; a search descends them greedily and
spreads in the lowest as a beam: the best nodes met and not yet expanded go next. Every
node within the threshold is expanded whatever the beam's width, so the many links of a
large group are not cut off.

How wide the beam has to be depends on the shard. After building, an audit asks for the
true links of some nodes (found by comparing with the whole shard) and for some nodes
themselves through copies moved away just to the threshold; the beam is doubled until
``RECALL`` of them are found, in the end to the whole shard, which is a plain scan.

Links are verified by the cosine in double precision. They are counted where they are
found, and only stars that connect what they connect are handed on, never all pairs.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchfold.llm.common import col, components, stars
from watchfold.session import keep

LEAST = 0.93  # cosine of a link
SHARD = 8192  # nodes in a graph
BLOCK = 512  # nodes searched by one task in one shard
DEGREE = 16  # neighbours of a node; twice as many in the lowest layer
BUILD_BEAM = 64
FIRST_BEAM = 64
RECALL = 0.99
AUDITED = 128  # nodes of a shard that are asked for
AT_ONCE = 16  # nodes of a beam expanded together


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; largest components first brought to one."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


class Graph:
    """A navigable small-world graph over unit vectors."""

    def __init__(self, vectors: np.ndarray, seed: int = 3):
        self.raw = vectors
        self.ready()
        n = len(vectors)
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(1 - rng.random(n)) / np.log(DEGREE)).astype(int), 6)
        self.links = [np.full((n, DEGREE * (1 if i else 2)), -1, np.int32) for i in range(int(self.level.max(initial=0)) + 1)]
        self.entry, self.seeds, self.beam = 0, np.empty(0, np.int64), FIRST_BEAM
        for i in range(1, n):
            self.insert(i)
        self.reach()
        self.widen(rng)

    def ready(self) -> None:
        self.exact = unit(self.raw) if len(self.raw) else self.raw.astype(np.float64)
        self.v = np.ascontiguousarray(self.exact, np.float32)
        self.met = np.zeros(len(self.raw), np.int64)
        self.round = 0

    def spread(self, q: np.ndarray, start: np.ndarray, beam: int, layer: int, least: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and cosines of a beam search, and all nodes met with a cosine of ``least`` or more."""
        links, v, met = self.links[layer], self.v, self.met
        self.round += 1
        met[start] = self.round
        ids, sims = start, v[start] @ q
        open_ = np.ones(len(ids), bool)
        while True:
            waiting = np.flatnonzero(open_)
            if not len(waiting):
                return ids, sims
            if len(waiting) > AT_ONCE:
                near = sims[waiting]
                cut = np.partition(near, -AT_ONCE)[-AT_ONCE]
                waiting = waiting[near >= min(cut, least)]
            open_[waiting] = False
            new = links[ids[waiting]].ravel()
            new = new[new >= 0]
            new = new[met[new] != self.round]
            if not len(new):
                continue
            new = np.unique(new)
            met[new] = self.round
            s = v[new] @ q
            if len(ids) >= beam:
                better = s > sims.min()
                new, s = new[better], s[better]
            ids, sims = np.concatenate([ids, new]), np.concatenate([sims, s])
            open_ = np.concatenate([open_, np.ones(len(new), bool)])
            if len(ids) > beam:
                cut = min(np.partition(sims, -beam)[-beam], least)
                stay = sims >= cut
                ids, sims, open_ = ids[stay], sims[stay], open_[stay]

    def diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` neighbours: those nearer to the node than to one already taken, then the nearest others."""
        order = np.argsort(-sims, kind="stable")
        ids, sims = ids[order], sims[order]
        between = self.v[ids] @ self.v[ids].T
        taken, best = [], np.full(len(ids), -2.0)
        for j in range(len(ids)):
            if sims[j] > best[j]:
                taken.append(j)
                if len(taken) == most:
                    break
                np.maximum(best, between[j], out=best)
        if len(taken) < most:
            rest = np.setdiff1d(np.arange(len(ids)), taken)
            taken += rest[: most - len(taken)].tolist()
        return ids[taken]

    def insert(self, i: int) -> None:
        q, top = self.v[i], int(self.level[self.entry])
        at = np.array([self.entry])
        for layer in range(top, int(self.level[i]), -1):
            ids, sims = self.spread(q, at, 1, layer)
            at = ids[[sims.argmax()]]
        for layer in range(min(top, int(self.level[i])), -1, -1):
            ids, sims = self.spread(q, at, BUILD_BEAM, layer)
            links = self.links[layer]
            chosen = self.diverse(ids, sims, DEGREE)
            links[i, : len(chosen)] = chosen
            for c in chosen:
                free = np.flatnonzero(links[c] < 0)
                if len(free):
                    links[c, free[0]] = i
                else:  # thinned to three quarters, so that this is rare
                    all_ = np.append(links[c], i)
                    kept = self.diverse(all_, self.v[all_] @ self.v[c], links.shape[1] * 3 // 4)
                    links[c] = -1
                    links[c, : len(kept)] = kept
            at = ids[np.argsort(-sims)[:8]]
        if self.level[i] > top:
            self.entry = i

    def reach(self) -> None:
        """Nodes that no way leads to from the entry become starts of every search, one for each such island."""
        n = len(self.raw)
        seen = np.zeros(n, bool)
        seeds, start = [], self.entry
        while n:
            front = np.array([start])
            seen[start] = True
            while len(front):
                out = self.links[0][front].ravel()
                out = np.unique(out[out >= 0])
                front = out[~seen[out]]
                seen[front] = True
            left = np.flatnonzero(~seen)
            if not len(left):
                break
            start = int(left[0])
            seeds.append(start)
        self.seeds = np.array(seeds, np.int64)

    def search(self, q: np.ndarray, least: float, beam: int | None = None) -> np.ndarray:
        """Nodes whose cosine with the unit vector ``q`` is ``least`` or more, as far as the beam finds them."""
        beam = beam or self.beam
        if not len(self.raw):
            return np.empty(0, np.int64)
        if beam >= len(self.raw):
            near = np.flatnonzero(self.v @ q.astype(np.float32) >= least - 1e-4)
        else:
            p = q.astype(np.float32)
            at = np.array([self.entry])
            for layer in range(int(self.level[self.entry]), 0, -1):
                ids, sims = self.spread(p, at, 1, layer)
                at = ids[[sims.argmax()]]
            start = np.unique(np.concatenate([at, self.seeds]))
            ids, sims = self.spread(p, start, beam, 0, least - 1e-4)
            near = ids[sims >= least - 1e-4]
        return near[self.exact[near] @ q >= least]

    def widen(self, rng: np.random.Generator) -> None:
        n = len(self.raw)
        asked = rng.permutation(n)[:AUDITED]
        true = [np.flatnonzero(self.exact @ self.exact[i] >= LEAST) for i in asked]
        moved = []
        for i in asked:  # at a cosine just above the least one
            aside = rng.normal(size=self.exact.shape[1])
            aside -= (aside @ self.exact[i]) * self.exact[i]
            length = np.linalg.norm(aside)
            c = LEAST + 1e-6
            moved.append(c * self.exact[i] + (1 - c * c) ** 0.5 * aside / length if length > 1e-9 else self.exact[i])
        while self.beam < n:
            found = sum(len(np.intersect1d(self.search(self.exact[i], LEAST), t)) for i, t in zip(asked, true, strict=True))
            again = sum(i in self.search(m, LEAST - 1e-6) for i, m in zip(asked, moved, strict=True))
            if found >= RECALL * sum(map(len, true)) and again >= RECALL * len(asked):
                break
            self.beam *= 2

    def dumps(self) -> bytes:
        state = {k: self.__dict__[k] for k in ("raw", "level", "links", "entry", "seeds", "beam")}
        for layer in range(1, len(self.links)):  # only rows of nodes that are in the layer
            state["links"] = [*state["links"][:layer], self.links[layer][self.level >= layer], *self.links[layer + 1 :]]
        return zlib.compress(pickle.dumps(state), 1)

    @classmethod
    def loads(cls, blob: bytes) -> Graph:
        out = cls.__new__(cls)
        out.__dict__.update(pickle.loads(zlib.decompress(blob)))
        for layer in range(1, len(out.links)):
            full = np.full((len(out.raw), out.links[layer].shape[1]), -1, np.int32)
            full[out.level >= layer] = out.links[layer]
            out.links[layer] = full
        out.ready()
        return out


def matrix(rows: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x) for x in rows])


def build(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("node", ignore_index=True)
    graph = Graph(matrix(frame["embedding"]))
    out = frame.loc[:0, ["label", "dim", "shard"]]
    return out.assign(nodes=[frame["node"].to_numpy().tobytes()], copies=[frame["copies"].to_numpy().tobytes()], graph=[graph.dumps()])


def pack(frame: pd.DataFrame) -> pd.DataFrame:
    out = frame.iloc[:1][["label", "dim", "own", "block"]].reset_index(drop=True)
    vectors = matrix(frame["embedding"])
    return out.assign(asked=[frame["node"].to_numpy().tobytes()], asks=[pickle.dumps(vectors)])


def search(frame: pd.DataFrame) -> pd.DataFrame:
    """Rows (a, b, links): counts of links of node a (b = a), and stars over the links found."""
    out = []
    for r in frame.itertuples(index=False):
        graph = Graph.loads(r.graph)
        nodes, copies = np.frombuffer(r.nodes, np.int64), np.frombuffer(r.copies, np.int64)
        asked, asks = np.frombuffer(r.asked, np.int64), unit(pickle.loads(r.asks))
        left, right = [], []
        for i, q in enumerate(asks):
            hit = graph.search(q, LEAST)
            hit = hit[nodes[hit] != asked[i]]
            if len(hit):
                out.append((int(asked[i]), int(asked[i]), int(copies[hit].sum())))
                left.append(np.full(len(hit), i))
                right.append(len(asked) + hit)
        if left:
            left, right = np.concatenate(left), np.concatenate(right)
            label = stars(len(asked) + len(nodes), left, right)
            both = np.concatenate([asked, nodes])
            some = np.unique(np.concatenate([left, right]))
            out += [(int(both[i]), int(both[label[i]]), 0) for i in some if label[i] != i]
    return pd.DataFrame(out, columns=["a", "b", "links"]).astype("int64")


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, ``n_links`` (other vectors linked directly), ``component_id`` and ``kept``.

    Vectors that are null, empty or zero, hold a null or a number that is not finite, or
    have a null label, link with nothing; so do vectors of different lengths. Repeated
    rows link with each other. A component without any id has a null id and is kept. An
    empty table gives an empty result. Equal distances are all links; further columns
    play no part, and vectors of any length are compared whole.
    """
    vectors = rows.select(
        col(vec_id).alias("vec_id"), col(embedding).alias("embedding"), col(label).alias("label"), F.size(col(embedding)).alias("dim")
    )
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = F.col("label").isNotNull() & (F.col("dim") > 0) & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0)
    vectors = vectors.withColumn("fine", F.coalesce(fine, F.lit(False)))
    same = vectors.where("fine").groupBy("label", "dim", "embedding")
    same = same.agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    # Numbers are given while writing, so they are fixed from here on.
    nodes = keep(same.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    sizes = keep(nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / SHARD).alias("shards")), "label-sizes")
    dealt = nodes.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(SHARD // BLOCK)))
    dealt = keep(dealt, "dealt-vectors")
    keys = dealt.select("label", "dim").schema
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys.fields)
    graphs = dealt.groupBy("label", "dim", "shard").applyInPandas(
        build, f"{head}, shard long, nodes binary, copies binary, graph binary"
    )
    graphs = keep(graphs, "graphs")
    blocks = dealt.withColumnRenamed("shard", "own").groupBy("label", "dim", "own", "block")
    blocks = blocks.applyInPandas(pack, f"{head}, own long, block long, asked binary, asks binary")
    pairs = blocks.join(graphs, ["label", "dim"])
    found = pairs.groupBy("label", "dim", "shard", "own", "block").applyInPandas(search, "a long, b long, links long")
    found = keep(found, "vector-links")
    counts = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where("a <> b").select("a", "b"))
    named = nodes.join(counts, "node", "left").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    named = keep(named.select("label", "dim", "embedding", "low", "root", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named-vectors")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lows, "root").select("label", "dim", "embedding", "n_links", "component_id")
    linked = vectors.where("fine").join(named, ["label", "dim", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = vectors.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
