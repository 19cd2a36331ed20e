import hashlib
import math

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.test_embeddings import SCHEMA
from watchfold.llm import codes
from watchfold.llm.common import table


def plain(points, books, rounds):
    """(entry per part, error, codebooks) by all comparisons."""
    n, parts, width = points.shape
    books = [[list(map(int, e)) for e in book] for book in books]
    for r in range(rounds + 1):
        said = np.empty((n, parts), int)
        error = np.zeros(n, int)
        for p in range(parts):
            size = ((points[:, p, None, :] - np.array(books[p])[None]) ** 2).sum(axis=2)
            said[:, p] = size.argmin(axis=1)
            error += size.min(axis=1)
        if r == rounds:
            return said, error, np.array(books)
        for p in range(parts):
            for e in range(len(books[p])):
                mine = points[said[:, p] == e, p]
                if len(mine):
                    books[p][e] = [math.floor(int(s) / len(mine)) for s in mine.sum(axis=0)]


def expected(rows):
    """Rows of the query, and what is dropped, from collected rows of one length."""
    good = [r for r in rows if r["embedding"] and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    good = [(r["vec_id"], r["label"], [math.floor(256 * x) for x in r["embedding"]]) for r in good]
    good.sort(key=lambda g: (g[0] is None, g[0] or 0, g[2]))
    points = np.array([g[2] for g in good]).reshape(len(good), 16, -1)
    said, error, books = plain(points, points[:64].transpose(1, 0, 2), 2)
    per = {}
    for g, e in zip(good, error, strict=True):
        per[g[1]] = per.get(g[1], 0) + int(e)
    sha = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    out = [(g[0], bytes(s.astype(np.uint8)).hex(), int(e), per[g[1]], sha) for g, s, e in zip(good, said, error)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, codes.compressed(df).collect()), key=repr)


def test_whole_table(spark):
    df = table(spark, SMALL, "embeddings")
    assert found(df) == expected(df.collect())


@pytest.mark.parametrize("n,spread", [(300, 40), (2500, 25), (65, 2), (40, 9), (1, 5)])
def test_trees_equal_all_comparisons(n, spread):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(12, 32)) * spread
    v = np.floor(centres[rng.integers(12, size=n)] + rng.normal(size=(n, 32)) * spread / 9).astype(np.int64)
    points = v.reshape(n, 8, 4)
    books = points[:50].transpose(1, 0, 2)
    said, error, last = plain(points, books, 2)
    trees = codes.Trees.loads(codes.Trees.grow(points.transpose(1, 0, 2), 8).dumps().to_pylist()[0], 8)
    for _ in range(2):
        count, sums = codes.totals(trees, codes.Trees.grow(books, 1))
        books = np.where(count[:, :, None] > 0, sums // np.maximum(count, 1)[:, :, None], books)
    assert np.array_equal(books, last)
    code, off = codes.nearest(trees, codes.Trees.grow(books, 1), books)
    assert np.array_equal(code, said) and np.array_equal(off, error)


def test_nodes_are_assigned_whole():
    """Far apart clusters: no leaf needs a comparison, and pairs far apart are dropped early."""
    rng = np.random.default_rng(2)
    v = (np.arange(16)[:, None, None] * 1000 + rng.integers(9, size=(16, 64, 4))).reshape(1, 1024, 4)
    books = np.arange(16)[None, :, None] * 1000 + np.zeros((1, 16, 4), np.int64)
    whole, leaf, _ = codes.walk(codes.Trees.grow(v, 8), codes.Trees.grow(books, 1))
    assert len(leaf) == 0 and 0 < sum(len(a) for _, a, _ in whole) <= 16


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(8)
    good = [[float(x) for x in v] for v in rng.normal(size=(90, 32))]
    rows = [(i, v, i % 3 or None) for i, v in enumerate(good)]
    rows += [(7, good[7], 1), (7, good[8], None), (None, good[3], 2), (None, good[4], 2)]
    bad = [(200, None, 1), (201, [], 1), (202, [nan] + good[0][1:], 1), (203, [inf] + good[0][1:], 1)]
    bad += [(204, [None] + good[0][1:], None), (205, [1e30] + good[0][1:], 1), (206, good[0][:16], 1), (-1, good[0][:9], 1)]
    df = spark.createDataFrame(rows + bad, SCHEMA).repartition(5)
    assert found(df) == expected([dict(zip(("vec_id", "embedding", "label"), r)) for r in rows])
    assert codes.compressed(spark.createDataFrame([], SCHEMA)).count() == 0
    assert codes.compressed(spark.createDataFrame(bad[:2], SCHEMA)).count() == 0


def test_clashing_names_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 37)
    df = table(spark, SMALL, "embeddings")
    more = df.selectExpr("*", "1 AS v", "'x' AS code", "label AS error", "map(1, 2) AS points", "3 AS n", "4 AS _key_label")
    assert found(more) == expected(df.collect())


def test_restore(spark):
    df = table(spark, SMALL, "embeddings")
    out = codes.encode(df)
    back = codes.restore(out.rows, out.books, out.scale).join(df, "vec_id")
    for r in back.select("restored", "embedding", "error").limit(40).collect():
        off = sum((math.floor(256 * x) + 0.5 - 256 * y) ** 2 for x, y in zip(r.embedding, r.restored, strict=True))
        assert abs(off - r.error) < 1e-6 * max(1, r.error)
