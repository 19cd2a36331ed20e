"""Centroid clustering by an incremental matrix of exact dot products.

Components become integers. Each stored block of vectors carries the dot product of
every vector with every centroid; squared distance is |v|^2 + |c|^2 - 2 v.c. After a
round, the products with a centroid change only by the components in which it moved, so
only those columns of the vectors are read for the update; then the nearest centroid is
taken again. A block also carries the numbers and sums of its vectors per centroid, so
that a round's means are gathered from the stored table, one row per component.

Defined results:

* kept are vectors of ``width`` components, none null or non-finite or beyond
  ``LARGEST / SCALE`` (their distances would not fit 64 bits); others, null and empty
  ones included, have no row;
* starting centroids are the kept vectors with the smallest sha256 of ``1:<id>``; among
  repeated rows the smaller components come first, null ids last;
* fewer kept vectors than centroids give fewer centroids; an empty table gives no rows;
* ties go to the smaller number; a centroid without vectors stays; repeated rows count
  as often as they stand there and give equal rows;
* further columns play no part; the columns are chosen by name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold.llm.codes import in_blocks, integers, one_list, usable
from watchfold.llm.common import col
from watchfold.session import keep

CENTROIDS = 16
ROUNDS = 3
SCALE = 64
WIDTH = 64
BLOCK = 8192


def moved(products: np.ndarray, vectors: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The dot products with ``new``, from those with ``old`` and the components that differ."""
    out = products.copy()
    for j, change in enumerate(new - old):
        at = np.flatnonzero(change)
        if len(at):
            out[:, j] += vectors[:, at] @ change[at]
    return out


def nearest(products: np.ndarray, vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance to it) of each vector."""
    size = (centroids * centroids).sum(axis=1) - 2 * products
    said = size.argmin(axis=1)
    return said, size[np.arange(len(size)), said] + (vectors * vectors).sum(axis=1)


def shares(vectors: np.ndarray, said: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    count, sums = np.bincount(said, minlength=k), np.zeros((k, vectors.shape[1]), np.int64)
    np.add.at(sums, said, vectors)
    return count, sums


@dataclass(frozen=True)
class Clusters:
    """``rows``: vec_id, cluster, distance of every kept vector; ``centroids``: (clusters, width) integers."""

    rows: DataFrame
    centroids: np.ndarray


def cluster(
    table: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    width: int = WIDTH,
) -> Clusters:
    """Fit ``k`` centroids on all rows and assign all rows."""
    kept = table.where(usable(col(vector), scale) & (F.size(col(vector)) == width))
    kept = kept.select(col(vec_id).alias("vec_id"), integers(col(vector), scale).alias("v"))
    by = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).asc_nulls_last()
    # The starting centroids: a fixed number of rows.
    begin = [r["v"] for r in kept.orderBy(by, "v").limit(k).select("v").collect()]
    centroids = np.array(begin, np.int64).reshape(-1, width)

    ids = T.StructField("vec_id", T.ArrayType(kept.schema["vec_id"].dataType))
    block = T.StructType([ids])
    for c in ("vectors", "products"):
        block = block.add(c, T.BinaryType())
    for c in ("count", "sums"):
        block = block.add(c, T.ArrayType(T.LongType()))

    def row(ids: pa.Array, vectors: np.ndarray, products: np.ndarray, now: np.ndarray) -> pa.RecordBatch:
        count, sums = shares(vectors, nearest(products, vectors, now)[0], len(now))
        small = np.int16 if not vectors.size or np.abs(vectors).max() < 1 << 15 else np.int32
        rest = [
            pa.array([vectors.astype(small).tobytes()], pa.binary()),
            pa.array([products.tobytes()], pa.binary()),
            pa.array([count.tolist()], pa.list_(pa.int64())),
            pa.array([sums.ravel().tolist()], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays([ids, *rest], names=block.names)

    def read(one: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        products = np.frombuffer(one["products"][0].as_buffer(), np.int64).reshape(-1, len(centroids))
        raw = one["vectors"][0].as_buffer()
        kind = np.int16 if raw.size == 2 * width * len(products) else np.int32
        return one["vec_id"], np.frombuffer(raw, kind).astype(np.int64).reshape(-1, width), products

    def begun(batches):
        for rows in in_blocks(batches, BLOCK):
            values = pa.concat_arrays(rows["v"].chunks).flatten().to_numpy(zero_copy_only=False)
            vectors = values.reshape(-1, width)
            yield row(one_list(rows["vec_id"]), vectors, vectors @ centroids.T, centroids)

    def step(old: np.ndarray, new: np.ndarray):
        def run(batches):
            for batch in batches:
                for at in range(batch.num_rows):
                    ids, vectors, products = read(batch.slice(at, 1))
                    yield row(ids, vectors, moved(products, vectors, old, new), new)

        return run

    def last(old: np.ndarray, new: np.ndarray):
        def run(batches):
            for batch in batches:
                for at in range(batch.num_rows):
                    ids, vectors, products = read(batch.slice(at, 1))
                    said, size = nearest(moved(products, vectors, old, new), vectors, new)
                    arrays = [ids.flatten(), pa.array(said.astype(np.int32)), pa.array(size)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance"])

        return run

    out = T.StructType([T.StructField("vec_id", kept.schema["vec_id"].dataType)])
    out = out.add("cluster", T.IntegerType()).add("distance", T.LongType())
    blocks, old, new = keep(kept.mapInArrow(begun, block), "dot-products"), centroids, centroids
    for r in range(rounds):
        if r:
            blocks = keep(blocks.select("vec_id", "vectors", "products").mapInArrow(step(old, new), block), "dot-products")
        old, new = new, means(blocks, new)
    rows = blocks.select("vec_id", "vectors", "products").mapInArrow(last(old, new), out)
    return Clusters(keep(rows, "clustered"), new)


def means(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floors of the means of each centroid's vectors; a centroid without vectors stays."""

    def gathered(name: str) -> dict[int, int]:
        parts = blocks.select(F.posexplode(name).alias("at", "x"))
        total = F.sum(F.col("x").cast("decimal(38,0)")).alias("x")
        # One row per centroid, or per component of one.
        return {r["at"]: int(r["x"]) for r in parts.groupBy("at").agg(total).collect()}

    count, sums = gathered("count"), gathered("sums")
    new, width = centroids.copy(), centroids.shape[1]
    for j in range(len(new)):
        if count.get(j):
            new[j] = [sums[j * width + i] // count[j] for i in range(width)]
    return new


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(table: DataFrame) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia and the digest of its centroid."""
    out = cluster(table)
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    # One row per cluster.
    parts = {r[0]: int(r[1]) for r in out.rows.groupBy("cluster").agg(exact).collect()}
    per = F.array(*[F.lit(parts.get(j, 0)).cast("long") for j in range(len(out.centroids))])
    names = F.array(*[F.lit(digest(c)) for c in out.centroids])
    if not parts:
        per, names = F.array(F.lit(0).cast("long")), F.array(F.lit(""))
    return out.rows.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(per, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(parts.values())).cast("long").alias("inertia"),
        F.get(names, F.col("cluster")).alias("centroid_sha256"),
    )


def _round(k: int) -> str:
    return f"""
d{k} AS (SELECT v.vec_id, c.j, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{k} c ON v.i = c.i GROUP BY v.vec_id, c.j),
a{k} AS (SELECT vec_id, arg_min(j, d * 16 + j) AS j, min(d) AS d FROM d{k} GROUP BY vec_id),
m{k} AS (SELECT a.j, v.i, CAST(floor(sum(v.x) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS x
  FROM v JOIN a{k} a ON v.vec_id = a.vec_id GROUP BY a.j, v.i),
c{k + 1} AS (SELECT c.j, c.i, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m ON c.j = m.j AND c.i = m.i)"""


#: The query in DuckDB's SQL.
SQL = f"""
WITH k AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
v AS (SELECT vec_id, unnest(range(64)) AS i, unnest(v) AS x FROM k),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256(concat('1:', CAST(vec_id AS VARCHAR)))) - 1 AS j FROM k),
c0 AS (SELECT s.j, v.i, v.x FROM v JOIN s ON v.vec_id = s.vec_id WHERE s.j < 16),
{_round(0)},
{_round(1)},
{_round(2)},
{_round(3)},
names AS (SELECT j, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY j)
SELECT a.vec_id, CAST(a.j AS INT) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  n.centroid_sha256
FROM a3 a JOIN names n ON a.j = n.j"""
