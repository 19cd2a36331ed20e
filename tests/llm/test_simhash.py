import numpy as np

from tests.conftest import SMALL
from tests.llm import brute
from watchfold.llm import simhash
from watchfold.llm.common import components, table


def expected(rows):
    prints = [(i, brute.simhash(t)) for i, t in rows]
    low = {}
    for i, f in prints:
        low[f] = min([x for x in (low.get(f), i) if x is not None], default=None)
    fs = sorted(low)
    arr = np.array(fs, np.uint64)
    pairs = [(fs[a], fs[b]) for a in range(len(fs)) for b in np.flatnonzero(np.bitwise_count(arr ^ arr[a]) <= 3) if b != a]
    root = brute.joined(fs, pairs)
    members = {}
    for f in fs:
        members.setdefault(root[f], []).append(low[f])
    best = {r: min((x for x in m if x is not None), default=None) for r, m in members.items()}
    return sorted(((i, f"{f:016x}", best[root[f]]) for i, f in prints), key=repr)


def test_whole_table(spark):
    docs = table(spark, SMALL, "documents")
    got = sorted((tuple(r) for r in simhash.simhash_components(docs).collect()), key=repr)
    assert got == expected([(d.doc_id, d.text) for d in docs.collect()])


def test_odd_rows(spark):
    texts = [None, "", " \n", "One", "one", "one two", "a b c", "É a b", "x y z \x1f w", "word " * 50_000]
    extra = [(3, "One", "en", "s", 1), (None, "One two", None, None, None), (None, "only here, without id", None, None, None)]
    docs = brute.documents(spark, texts, extra)
    got = sorted((tuple(r) for r in simhash.simhash_components(docs).collect()), key=repr)
    assert got == expected([(d.doc_id, d.text) for d in docs.collect()])
    assert simhash.simhash_components(brute.documents(spark, [])).count() == 0


def test_crowded_shards_equal_plain_search(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 16)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 6)
    fps = {int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i in range(0, 40, 3) for j in range(1, 62, 7)}
    fps |= {int(x) for x in rng.integers(0, 2**63, 400)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.root for r in components(simhash.fingerprint_links(df)).collect()}
    arr = np.array(sorted(fps), np.int64)
    pairs = [(int(arr[a]), int(arr[b])) for a in range(len(arr)) for b in np.flatnonzero(np.bitwise_count(arr ^ arr[a]) <= 3)]
    want = brute.joined([int(x) for x in arr], pairs)
    assert {x: got.get(x, x) for x in want} == want


def test_more_bits_for_more_rows():
    for n in (10, 10**7, 10**9, 10**12):
        masks = simhash.blocks_for(n)
        rng = np.random.default_rng(3)
        for _ in range(50):
            off = set(rng.choice(64, 3, replace=False))
            assert any(not off & set(m) for m in masks)
    assert len(simhash.blocks_for(10)) == 4 and len(simhash.blocks_for(10**9)) > 4


def test_components_of_a_long_chain(spark):
    links = spark.range(300).selectExpr("id a", "id + 1 b").union(spark.createDataFrame([(900, 901), (901, 900)], "a long, b long"))
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(301)}, 900: 900, 901: 900}
