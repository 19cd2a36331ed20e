"""Vector codes: each part of a vector is replaced by the number of a codebook entry, by dual-tree Lloyd.

Components become integers, so every sum and distance is exact. Each block of vectors
holds, per part position, a balanced tree over its parts with the box, the number and
the sum of the parts below each node; it is built once and stored. A round builds the
same kind of tree over each codebook's entries and walks both trees level by level.
Bounds on the distance between two boxes drop pairs of nodes; a node that is left with
one entry is assigned as a whole, by its stored sum. Only leaves that stay undecided
compare parts with the entries left to them, in integers.

Defined results:

* vectors that are null, empty, or hold a null or non-finite component are dropped, and
  so are those with a component beyond ``LARGEST / SCALE``, whose squared distances
  would not fit 64 bits;
* all vectors have one length: that of the first kept row by (id, components) whose
  length is a multiple of the number of parts; rows of another length are dropped;
* repeated rows count as often as they stand there, and give equal rows; among equal ids
  the starting entries are taken by components; null ids come last;
* fewer kept rows than entries give smaller codebooks; no rows give an empty result;
* equally near entries: the lower number. Equal labels share a sum, nulls together;
* vectors of any length that is allowed are worked on whole, ``BLOCK`` rows at a time;
* further columns play no part; the columns are chosen by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold.llm.common import attach, col
from watchfold.session import keep

PARTS = 16
ENTRIES = 64  # at most 256: a code is two hex digits
ROUNDS = 2
SCALE = 256
BLOCK = 8192
LEAF = 32
LARGEST = 1 << 27


def integers(vector: Column, scale: int) -> Column:
    """The components as floor(scale * x), each first widened to double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column, scale: int) -> Column:
    """Not null, and every component present, finite and small enough for exact distances."""
    most = F.lit(LARGEST / scale)
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) <= most), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


STORED = pa.schema(
    [(c, pa.int32()) for c in ("n", "depth", "bits")]
    + [(c, pa.binary()) for c in ("points", "order", "boxes", "counts", "sums")]
)


class Trees:
    """A balanced tree over each of several equally large sets of points.

    ``points`` (sets, rows, width) stand in the order of the leaves and ``order`` holds
    their numbers; rows are filled up to a full tree by copies of the last point, whose
    numbers are ``n`` and more and which count for nothing. At level l, node i of set s
    is row s * 2**l + i of ``low[l]``, ``high[l]``, ``count[l]`` and ``sums[l]``.
    """

    def __init__(self, points: np.ndarray, n: int, order: np.ndarray, depth: int):
        self.points, self.n, self.order, self.depth = points, n, order, depth

    @staticmethod
    def grow(points: np.ndarray, leaf: int) -> "Trees":
        sets, n, width = points.shape
        depth = 0
        while n > leaf << depth:
            depth += 1
        rows = -(-n // (1 << depth)) << depth
        order = np.broadcast_to(np.arange(rows), (sets, rows))
        points = points[:, np.minimum(np.arange(rows), n - 1)]
        for level in range(depth):
            nodes = points.reshape(sets << level, rows >> level, width)
            widest = (nodes.max(axis=1) - nodes.min(axis=1)).argmax(axis=1)
            along = np.take_along_axis(nodes, widest[:, None, None], axis=2)[:, :, 0]
            by = np.argsort(along, axis=1, kind="stable")
            points = np.take_along_axis(nodes, by[:, :, None], axis=1).reshape(sets, rows, width)
            order = np.take_along_axis(order.reshape(by.shape), by, axis=1).reshape(sets, rows)
        tree = Trees(points, n, order, depth)
        leaves = points.reshape(sets << depth, rows >> depth, width)
        real = (order < n).reshape(leaves.shape[:2])
        tree.low, tree.high = [leaves.min(axis=1)], [leaves.max(axis=1)]
        tree.count, tree.sums = [real.sum(axis=1)], [(leaves * real[:, :, None]).sum(axis=1)]
        for _ in range(depth):
            tree.low.insert(0, np.minimum(tree.low[0][0::2], tree.low[0][1::2]))
            tree.high.insert(0, np.maximum(tree.high[0][0::2], tree.high[0][1::2]))
            tree.count.insert(0, tree.count[0][0::2] + tree.count[0][1::2])
            tree.sums.insert(0, tree.sums[0][0::2] + tree.sums[0][1::2])
        return tree

    def dumps(self) -> pa.RecordBatch:
        """One row, by ``STORED``."""
        small = np.int16 if np.abs(self.points).max() < 1 << 15 else np.int32
        row = {
            "n": self.n,
            "depth": self.depth,
            "bits": 8 * small().itemsize,
            "points": self.points.astype(small).tobytes(),
            "order": self.order.astype(np.int32).tobytes(),
            "boxes": np.concatenate([*self.low, *self.high]).astype(small).tobytes(),
            "counts": np.concatenate(self.count).astype(np.int32).tobytes(),
            "sums": np.concatenate(self.sums).astype(np.int64).tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=STORED)

    @staticmethod
    def loads(row: dict, sets: int) -> "Trees":
        kind = np.int16 if row["bits"] == 16 else np.int32
        order = np.frombuffer(row["order"], np.int32).reshape(sets, -1).astype(np.int64)
        points = np.frombuffer(row["points"], kind).astype(np.int64).reshape(*order.shape, -1)
        tree = Trees(points, row["n"], order, row["depth"])
        ends = np.cumsum([sets << level for level in range(row["depth"])])
        boxes = np.frombuffer(row["boxes"], kind).astype(np.int64).reshape(2, -1, points.shape[2])
        tree.low, tree.high = np.split(boxes[0], ends), np.split(boxes[1], ends)
        tree.count = np.split(np.frombuffer(row["counts"], np.int32).astype(np.int64), ends)
        tree.sums = np.split(np.frombuffer(row["sums"], np.int64).reshape(-1, points.shape[2]), ends)
        return tree


def starts(groups: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.empty(0, np.int64)


def walk(points: Trees, entries: Trees) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Whole nodes with their entry, as (level, nodes, entry numbers), and the pairs (leaf, entry place) left over."""
    sets = len(entries.points)
    a = b = np.arange(sets)
    up = down = 0  # levels of the points' and the entries' nodes
    whole: list[tuple[int, np.ndarray, np.ndarray]] = []
    number = entries.order.ravel()
    while True:
        la, ha, lb, hb = points.low[up][a], points.high[up][a], entries.low[down][b], entries.high[down][b]
        gap = np.maximum(0, np.maximum(lb - ha, la - hb))
        reach = np.maximum(ha - lb, hb - la)
        near, far = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        first = starts(a)
        runs = np.diff(np.r_[first, len(a)])
        left = near <= np.repeat(np.minimum.reduceat(far, first), runs)
        if down == entries.depth:
            # Single entries: the one nearest to the middle of the box may be nearer than another for all of it.
            off = 2 * lb - la - ha
            size = (off * off).sum(axis=1)
            best = np.repeat(np.minimum.reduceat(size, first), runs)
            rank = np.where(size == best, np.arange(len(a)), len(a))
            best = np.repeat(np.minimum.reduceat(rank, first), runs)
            c = lb[best]
            corner = np.where(c > lb, la, ha)
            lead = (c * c - lb * lb - 2 * corner * (c - lb)).sum(axis=1)
            mine, other = number[b], number[b[best]]
            left &= (number[b] < entries.n) & ~((lead < 0) | ((lead == 0) & (other < mine)))
        a, b = a[left], b[left]
        if down == entries.depth:
            first = starts(a)
            alone = np.diff(np.r_[first, len(a)]) == 1
            whole.append((up, a[first[alone]], number[b[first[alone]]]))
            rest = np.repeat(~alone, np.diff(np.r_[first, len(a)]))
            a, b = a[rest], b[rest]
            if up == points.depth:
                return whole, a, b
        if not len(a):
            return whole, a, b
        if up < points.depth:
            up, a, b = up + 1, np.concatenate([2 * a, 2 * a + 1]), np.concatenate([b, b])
        if down < entries.depth:
            down, a, b = down + 1, np.concatenate([a, a]), np.concatenate([2 * b, 2 * b + 1])
        by = np.argsort(a, kind="stable")
        a, b = a[by], b[by]


def compared(points: Trees, entries: Trees, leaf: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(leaves, entry number of each of their points) for the pairs that the walk left over."""
    width = points.points.shape[2]
    leaves = points.points.reshape(len(points.low[-1]), -1, width)
    values, number = entries.points.reshape(-1, width), entries.order.ravel()
    step = max(1, (1 << 19) // (leaves.shape[1] * width))
    first = starts(leaf)
    at = 0
    while at < len(first):
        end = max(at + 1, int(np.searchsorted(first, first[at] + step)))
        stop = first[end] if end < len(first) else len(leaf)
        some, rows = slice(first[at], stop), first[at:end] - first[at]
        off = leaves[leaf[some]] - values[place[some]][:, None, :]
        size = (off * off).sum(axis=2)
        best = np.repeat(np.minimum.reduceat(size, rows), np.diff(np.r_[rows, len(size)]), axis=0)
        named = np.where(size == best, number[place[some]][:, None], len(number))
        yield leaf[first[at:end]], np.minimum.reduceat(named, rows)
        at = end


def totals(points: Trees, entries: Trees) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points nearest to each entry: (sets, entries) and (sets, entries, width)."""
    sets, _, width = points.points.shape
    count = np.zeros(sets * entries.n, np.int64)
    sums = np.zeros((sets * entries.n, width), np.int64)
    whole, leaf, place = walk(points, entries)
    for level, node, entry in whole:
        to = (node >> level) * entries.n + entry
        np.add.at(count, to, points.count[level][node])
        np.add.at(sums, to, points.sums[level][node])
    leaves = points.points.reshape(len(points.low[-1]), -1, width)
    real = (points.order < points.n).reshape(leaves.shape[:2])
    for at, entry in compared(points, entries, leaf, place):
        to = ((at >> points.depth)[:, None] * entries.n + entry)[real[at]]
        np.add.at(count, to, 1)
        np.add.at(sums, to, leaves[at][real[at]])
    return count.reshape(sets, -1), sums.reshape(sets, entries.n, width)


def nearest(points: Trees, entries: Trees, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: its entry in each set, and the sum of the squared distances to them."""
    sets, rows, width = points.points.shape
    said = np.empty((sets, rows), np.int64)
    whole, leaf, place = walk(points, entries)
    for level, node, entry in whole:
        said.reshape(sets << level, -1)[node] = entry[:, None]
    for at, entry in compared(points, entries, leaf, place):
        said.reshape(sets << points.depth, -1)[at] = entry
    off = points.points - np.take_along_axis(books, said[:, :, None], axis=1)
    size = (off * off).sum(axis=2)
    code, error = np.empty((rows, sets), np.int64), np.zeros(rows, np.int64)
    for s in range(sets):
        code[points.order[s], s] = said[s]
        error[points.order[s]] += size[s]
    return code[: points.n], error[: points.n]


def in_blocks(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
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


def one_list(column: pa.ChunkedArray) -> pa.Array:
    """A whole column as one list."""
    values = pa.concat_arrays(column.chunks)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


@dataclass(frozen=True)
class Codes:
    """``rows``: vec_id, label, code, error of every kept vector; ``books``: (parts, entries, width) integers."""

    rows: DataFrame
    books: np.ndarray
    scale: int


def encode(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codes:
    """Fit the codebooks on all rows and encode all rows."""
    spark = vectors.sparkSession
    kept = vectors.where(usable(col(vector), scale)).select(
        col(vec_id).alias("vec_id"), col(label).alias("label"), integers(col(vector), scale).alias("v")
    )
    kept = kept.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = kept.orderBy(*order).select(F.size("v")).first()
    width = first[0] // parts if first else 1
    kept = kept.where(F.size("v") == width * parts)
    # The starting entries: a fixed number of rows.
    begin = [r["v"] for r in kept.orderBy(*order).limit(entries).select("v").collect()]
    books = np.array(begin, np.int64).reshape(-1, parts, width).transpose(1, 0, 2)

    types = dict(zip(kept.columns, [f.dataType for f in kept.schema.fields], strict=True))
    block = T.StructType(
        [T.StructField("vec_id", T.ArrayType(types["vec_id"])), T.StructField("label", T.ArrayType(types["label"]))]
        + [T.StructField(c, T.IntegerType()) for c in ("n", "depth", "bits")]
        + [T.StructField(c, T.BinaryType()) for c in ("points", "order", "boxes", "counts", "sums")]
    )

    def plant(batches):
        for rows in in_blocks(batches, BLOCK):
            values = pa.concat_arrays(rows["v"].chunks).flatten().to_numpy(zero_copy_only=False)
            points = values.reshape(rows.num_rows, parts, width).transpose(1, 0, 2)
            tree = Trees.grow(points, LEAF).dumps()
            arrays = [one_list(rows["vec_id"]), one_list(rows["label"]), *tree.columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", *STORED.names])

    blocks = keep(kept.mapInArrow(plant, block), "part-trees")
    for _ in range(rounds if begin else 0):
        books = means(blocks, books)

    scored = T.StructType([T.StructField("vec_id", types["vec_id"]), T.StructField("label", types["label"])])
    scored = scored.add("code", T.StringType()).add("error", T.LongType())

    def assign(batches):
        tree = Trees.grow(books, 1) if books.size else None  # no rows either
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                points = Trees.loads(row.select(STORED.names).to_pylist()[0], parts)
                code, error = nearest(points, tree, books)
                text = code.astype(np.uint8).tobytes().hex()
                step = 2 * parts
                said = pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [row["vec_id"].flatten(), row["label"].flatten(), said, pa.array(error)],
                    names=["vec_id", "label", "code", "error"],
                )

    return Codes(keep(blocks.mapInArrow(assign, scored), "vector-codes"), books, scale)


def means(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: the floors of the means of the parts nearest to each entry; unused entries stay."""
    parts, entries, width = books.shape

    def add(batches):
        tree = Trees.grow(books, 1)
        count, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                n, s = totals(Trees.loads(row, parts), tree)
                count += n
                sums += s
        used = np.flatnonzero(np.repeat(count.ravel() > 0, width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(np.repeat(count.ravel(), width)[used]), pa.array(sums.ravel()[used])],
            names=["place", "n", "total"],
        )

    shares = blocks.select(*STORED.names).mapInArrow(add, "place long, n long, total long")
    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    new = books.copy().ravel()
    # One row per component of the codebooks.
    for r in shares.groupBy("place").agg(F.sum("n").alias("n"), exact.alias("total")).collect():
        new[r["place"]] = int(r["total"]) // r["n"]
    return new.reshape(books.shape)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def restore(codes: DataFrame, books: np.ndarray, scale: int, code: str = "code") -> DataFrame:
    """``codes`` with ``restored``: the vector of the middles of its entries' intervals; null codes give null."""
    parts, entries, width = books.shape
    flat = F.array(*[F.array(*[F.lit((int(x) + 0.5) / scale) for x in e]) for e in books.reshape(-1, width)])

    def part(i: Column) -> Column:
        return flat[(i * entries + F.conv(F.substring(col(code), i * 2 + 1, 2), 16, 10).cast("int")).cast("int")]

    whole = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), part))
    return codes.withColumn("restored", F.when(col(code).isNotNull(), whole))


def compressed(vectors: DataFrame) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error and the digest of the codebooks."""
    out = encode(vectors)
    shares = out.rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    rows = attach(out.rows, shares, ["label"])
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest(out.books)).alias("codebooks_sha256"))


def _round(k: int) -> str:
    same = " + ".join(f"(p.s[{j}] - c.s[{j}]) * (p.s[{j}] - c.s[{j}])" for j in range(1, 5))
    means = ", ".join(f"CAST(floor(sum(p.s[{j}]) / CAST(count(*) AS DOUBLE)) AS BIGINT)" for j in range(1, 5))
    return f"""
a{k} AS (SELECT p.rn, p.part, min(({same}) * 64 + c.e) AS best FROM p JOIN c{k} c ON p.part = c.part GROUP BY p.rn, p.part),
m{k} AS (SELECT p.part, CAST(a.best % 64 AS BIGINT) AS e, [{means}] AS s FROM p JOIN a{k} a ON p.rn = a.rn AND p.part = a.part
  GROUP BY p.part, a.best % 64),
c{k + 1} AS (SELECT c.part, c.e, coalesce(m.s, c.s) AS s FROM c{k} c LEFT JOIN m{k} m ON c.part = m.part AND c.e = m.e)"""


#: The query in DuckDB's SQL, for vectors of 64 components.
SQL = f"""
WITH k AS (
  SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v,
    row_number() OVER (ORDER BY vec_id) AS rn
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT rn, part, v[part * 4 + 1 : part * 4 + 4] AS s FROM k, (SELECT unnest(range(16)) AS part) AS parts),
c0 AS (SELECT part, rn - 1 AS e, s FROM p WHERE rn <= 64),
{_round(0)},
{_round(1)},
{_round(2)},
codes AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', CAST(a.best % 64 AS BIGINT)), '' ORDER BY a.part) AS code,
    CAST(sum(CAST(floor(a.best / 64.0) AS BIGINT)) AS BIGINT) AS error
  FROM k JOIN a2 a ON k.rn = a.rn GROUP BY k.rn, k.vec_id, k.label),
books AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, j)) AS codebooks_sha256
  FROM (SELECT part, e, unnest(range(4)) AS j, unnest(s) AS x FROM c2))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes, books"""
