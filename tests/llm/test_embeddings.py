import math

import numpy as np

from tests.conftest import SMALL
from tests.llm import brute
from watchfold.llm import embeddings
from watchfold.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """(vec_id, links, component) of each row, by all comparisons."""
    good = []
    for r in rows:
        v = r["embedding"]
        fine = r["label"] is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if fine else None)
    links, pairs = [0] * len(rows), []
    for i, a in enumerate(good):
        for j, b in enumerate(good):
            if i != j and a is not None and b is not None and len(a) == len(b) and rows[i]["label"] == rows[j]["label"] and a @ b >= 0.93:
                links[i] += 1
                pairs.append((i, j))
    root = brute.joined(range(len(rows)), pairs)
    low = {}
    for i, r in enumerate(root.values()):
        low[r] = min([x for x in (low.get(r), rows[i]["vec_id"]) if x is not None], default=None)
    return sorted(((r["vec_id"], links[i], low[root[i]]) for i, r in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()), key=repr)


def test_whole_table(spark):
    rows = table(spark, SMALL, "embeddings")
    assert found(rows) == plain(rows.collect())
    assert all(r.kept == (r.vec_id == r.component_id) for r in embeddings.near_vectors(rows).collect())


def test_groups_over_shards(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SHARD", 128)
    monkeypatch.setattr(embeddings, "BLOCK", 32)
    rng = np.random.default_rng(4)
    vectors = []
    for size in (150, 40, 2, 2, 1, 1):
        base = rng.normal(size=16)
        vectors += [base + rng.normal(size=16) * 0.1 * np.linalg.norm(base) / 4 for _ in range(size)]
    vectors += list(rng.normal(size=(300, 16)))
    rows = [(i, [float(x) for x in v], i % 7 // 6) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(0, 60, 3)] + [(7, rows[7][1], rows[7][2])]
    df = spark.createDataFrame(rows, SCHEMA).cache()
    got, want = found(df), plain(df.collect())
    total = sum(w[1] for w in want)
    assert sum(g[1] for g in got) >= 0.97 * total and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[2] == w[2] for g, w in zip(got, want, strict=True)) >= 0.98 * len(want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None, 1), (1, [], 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1)]
    rows += [(6, [1.0, 0.0], None), (7, [1.0, 0.0], 1), (8, [1e30, 1e28], 1), (9, [1e-30, 0.0], 1), (9, [1e-30, 0.0], 1)]
    rows += [(10, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (11, [1.0, 0.0], 2), (12, [-1.0, -0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == plain(df.collect())
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_of_one_graph():
    rng = np.random.default_rng(9)
    v = rng.normal(size=(1500, 32)).astype(np.float32)
    v[700:1400] = v[:700] + 0.2 * rng.normal(size=(700, 32))
    graph = embeddings.Graph.loads(embeddings.Graph(v).dumps())
    u = embeddings.unit(v)
    true = u @ u.T >= 0.93
    got = [graph.search(x, 0.93) for x in u]
    assert all(true[i, g].all() for i, g in enumerate(got))
    assert sum(map(len, got)) >= 0.98 * true.sum()
