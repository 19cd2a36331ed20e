"""Near copies by SimHash: fingerprints that differ in at most 3 bits, found in BK-trees.

A BK-tree hangs each fingerprint below a parent under the integer Hamming distance
between them; a search for radius r at a node of distance d follows only the edges
from d - r to d + r. One tree over everything would be searched nearly whole, so
trees are sharded: the 64 bits are cut into blocks, and two fingerprints at distance r
agree in all but r blocks. There is a shard for each choice of agreeing blocks and
their bits; within it all searches stay. Shards of more than ``SHARD`` fingerprints
are cut into sub-trees, and each pair of sub-trees is one group of bounded size, so a
great number of near copies spreads over many tasks. Trees travel to their searches
by shuffle: their total size has no bound that would allow a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchfold.llm.common import col, components, own_name, partitions, stars, whole_groups
from watchfold.session import keep

WIDTH = 3  # words in a shingle
RADIUS = 3  # differing bits of a link
SEED = 42
SHARD = 2048  # fingerprints in a tree
CROWD = 64  # fingerprints expected in a shard, above which shards agree in more bits
STEP = 4096  # searches at once


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """SimHash of a whole UTF-8 text over its word shingles, as an unsigned number; no word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter(
        (digest(join(s), SEED) for s in zip(*(words[i:] for i in range(width)), strict=False)),
        np.dtype("<u8"),
        len(words) - width + 1,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", name: str = "fp", width: int = WIDTH) -> DataFrame:
    """``df`` with the fingerprint of ``text`` (null: as empty) as a signed long."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t or b"", width) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return df.withColumn(name, fp(col(text).cast("binary")))


def blocks_for(n: int, radius: int = RADIUS) -> list[tuple[int, ...]]:
    """Masks, as tuples of bits, so that two fingerprints within ``radius`` agree under one of them.

    ``radius`` + k blocks, k of them chosen, with the smallest k that makes a shard of
    ``n`` spread fingerprints hold at most ``CROWD``.
    """
    for k in range(1, 5):
        edges = [64 * i // (radius + k) for i in range(radius + k + 1)]
        parts = [tuple(range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
        masks = [sum(chosen, ()) for chosen in combinations(parts, k)]
        if n <= CROWD << min(map(len, masks)):
            break
    return masks


class Trees:
    """BK-trees of many groups at once, grown level by level on arrays."""

    def __init__(self, fp: np.ndarray, group: np.ndarray):
        """``fp``: unsigned; ``group``: numbers from 0, sorted."""
        self.fp = fp
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(fp) else np.empty(0, np.int64)
        self.roots = np.full(group.max() + 1 if len(fp) else 0, -1)
        self.roots[group[first]] = first
        parent, edge = np.full(len(fp), -1), np.zeros(len(fp), np.int64)
        at = self.roots[group]
        rest = np.setdiff1d(np.arange(len(fp)), first)
        while len(rest):
            d = np.bitwise_count(fp[rest] ^ fp[at[rest]]).astype(np.int64)
            _, new, to = np.unique(at[rest] * 65 + d, return_index=True, return_inverse=True)
            child = rest[new]
            parent[child], edge[child] = at[child], d[new]
            at[rest] = child[to]
            rest = np.delete(rest, new)
        self.order = np.argsort(parent, kind="stable")
        self.edge = edge[self.order]
        self.start = np.searchsorted(parent[self.order], np.arange(len(fp)))
        self.end = np.searchsorted(parent[self.order], np.arange(len(fp)), side="right")

    def within(self, fp: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index of search, index of node) of each pair within ``radius``, level by level."""
        root = np.where(group < len(self.roots), self.roots[np.minimum(group, len(self.roots) - 1)], -1)
        q = np.flatnonzero(root >= 0)
        node = root[q]
        while len(q):
            d = np.bitwise_count(fp[q] ^ self.fp[node]).astype(np.int64)
            hit = d <= radius
            yield q[hit], node[hit]
            n = self.end[node] - self.start[node]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[node], n)
            follow = np.abs(self.edge[place] - np.repeat(d, n)) <= radius
            q, node = np.repeat(q, n)[follow], self.order[place[follow]]


def links_in(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Links of whole groups (mask, bits, left, right): stars that connect what the trees connect."""
    frame = frame.sort_values(["mask", "bits", "left", "right"], kind="stable", ignore_index=True)
    keys = frame[["mask", "bits", "left", "right"]].to_numpy()
    group = np.cumsum(np.r_[False, (keys[1:] != keys[:-1]).any(axis=1)])
    fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
    held = np.flatnonzero(frame["held"].to_numpy())
    asks = np.flatnonzero(frame["asks"].to_numpy())
    trees = Trees(fp[held], group[held])
    label = np.arange(len(frame))
    for at in range(0, len(asks), STEP):
        some = asks[at : at + STEP]
        for q, node in trees.within(fp[some], group[some], radius):
            a, b = some[q], held[node]
            other = a != b
            if other.any():
                label = stars(len(frame), np.r_[a[other], np.arange(len(frame))], np.r_[b[other], label])
    far = label != np.arange(len(frame))
    return pd.DataFrame({"a": fp[far].view(np.int64), "b": fp[label[far]].view(np.int64)})


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp``, enough to connect all within ``radius``."""
    spark = distinct.sparkSession
    masks = blocks_for(distinct.count(), radius)

    def bits(mask: tuple[int, ...]):
        """The bits under the mask, runs of neighbours shifted together."""
        out, width, run = F.lit(0).cast("long"), 0, []
        for b in [*mask, -2]:
            if run and b != run[-1] + 1:
                piece = F.shiftrightunsigned("fp", run[0]).bitwiseAND(F.lit((1 << len(run)) - 1))
                out = out.bitwiseOR(F.shiftleft(piece, width))
                width, run = width + len(run), []
            run.append(b)
        return out

    shards = F.posexplode(F.array(*[bits(m) for m in masks])).alias("mask", "bits")
    rows = distinct.select("fp", shards)
    sizes = rows.groupBy("mask", "bits").count().where(F.col("count") > SHARD)
    sizes = keep(sizes.select("mask", "bits", F.ceil(F.col("count") / SHARD).alias("cut")), "crowded-shards")
    rows = rows.join(sizes, ["mask", "bits"], "left").withColumn("cut", F.coalesce("cut", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("cut"))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    rows = rows.select(
        "mask",
        "bits",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
        "fp",
        (F.col("own") <= F.col("other")).alias("held"),
        (F.col("own") >= F.col("other")).alias("asks"),
    )
    keys = ["mask", "bits", "left", "right"]

    def search(batches):
        for frame in whole_groups(batches, keys, 20_000):
            yield links_in(frame, radius)

    rows = rows.repartition(partitions(spark), *keys).sortWithinPartitions(*keys)
    return rows.mapInPandas(search, "a long, b long")


def near_groups(rows: DataFrame, doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """For each distinct fingerprint ``fp`` of ``rows``: ``component_id``, the smallest id it reaches.

    Null ids count only where a component has no other (then: null).
    """
    distinct = keep(rows.groupBy("fp").agg(F.min(col(doc_id)).alias("low")), "fingerprints")
    roots = keep(components(fingerprint_links(distinct, radius)), "fingerprint-components")
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    named = keep(joined.select("fp", "low", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return named.select("fp", "root").join(lows, "root").select("fp", "component_id")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Null and empty texts have the fingerprint zero and link like any other; repeated
    rows stay, with equal results; an empty table gives an empty result. A text of any
    length is hashed whole; a bit that is set in just half the shingles is 0. Further
    columns play no part.
    """
    rows = fingerprints(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")), "text")
    rows = keep(rows.select("doc_id", "fp"), "document-fingerprints")
    out = rows.join(near_groups(rows, radius=radius), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
