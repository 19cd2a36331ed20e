import hashlib
import math

import numpy as np

from tests.conftest import SMALL
from tests.llm.test_embeddings import SCHEMA
from watchfold.llm import centroids
from watchfold.llm.common import table


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    """Rows of the query, every distance taken anew in every round."""
    fine = lambda v: v is not None and len(v) == 64 and all(x is not None and abs(x) <= 1 << 21 for x in v)
    good = [(r["vec_id"], [math.floor(64 * x) for x in r["embedding"]]) for r in rows if fine(r["embedding"])]
    good.sort(key=lambda g: (g[0] is None, sha(f"1:{g[0]}"), g[1]))
    v = np.array([g[1] for g in good]).reshape(-1, 64)
    c = v[:16].copy()
    for r in range(4):
        size = ((v[:, None, :] - c[None]) ** 2).sum(axis=2)
        said = size.argmin(axis=1)
        if r < 3:
            for j in range(len(c)):
                if (said == j).any():
                    c[j] = [int(s) // int((said == j).sum()) for s in v[said == j].sum(axis=0)]
    near = size.min(axis=1)
    out = []
    for g, j, d in zip(good, said, near, strict=True):
        name = sha(",".join(map(str, c[j])))
        out.append((g[0], int(j), int(d), int(near[said == j].sum()), int(near.sum()), name))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, centroids.clustered(df).collect()), key=repr)


def test_whole_table(spark):
    df = table(spark, SMALL, "embeddings")
    assert found(df) == expected(df.collect())


def test_blocks_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 41)
    df = table(spark, SMALL, "embeddings")
    more = df.selectExpr("*", "1 AS v", "2 AS cluster", "map(1, 2) AS distance", "'x' AS products", "5 AS `count`")
    assert found(more) == expected(df.collect())


def test_products_follow_changed_components():
    rng = np.random.default_rng(3)
    v, old = rng.integers(-50, 50, size=(200, 64)), rng.integers(-50, 50, size=(16, 64))
    new = old.copy()
    new[3, 5] += 9
    new[7] = rng.integers(-50, 50, size=64)
    assert np.array_equal(centroids.moved(v @ old.T, v, old, new), v @ new.T)
    # Only the columns of changed components are read.
    v2 = v.copy()
    v2[:, 6] = 10**6
    one = old.copy()
    one[3, 5] += 9
    assert np.array_equal(centroids.moved(v @ old.T, v2, old, one), centroids.moved(v @ old.T, v, old, one))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    good = [[float(np.float32(x)) for x in v] for v in rng.normal(size=(60, 64))]
    rows = [(i, v, 1) for i, v in enumerate(good)]
    rows += [(5, good[5], 1), (5, good[6], None), (None, good[3], 2), (9, [0.0] * 64, 2), (70, [1e5] * 64, 1)]
    rows += [(80, None, 1), (81, [], 1), (82, [nan] + good[0][1:], 1), (83, [-inf] + good[0][1:], 1)]
    rows += [(84, [None] + good[0][1:], 1), (85, good[0][:63], 1), (86, good[0] + [1.0], 1), (87, [1e30] + good[0][1:], 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df) == expected(df.collect())
    few = df.where("vec_id < 7")
    assert found(few) == expected(few.collect())
    assert centroids.clustered(spark.createDataFrame([], SCHEMA)).count() == 0
    assert centroids.clustered(df.where("vec_id = 80")).count() == 0
