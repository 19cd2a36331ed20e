import collections

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm import brute
from watchfold.llm import mixing
from watchfold.llm.common import table


def plain_targets(sizes):
    """Share, cap, share the excess again, in rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full, rest = {s: 0.0 for s in names}, set(), sum(sizes.values())
    while rest > 1e-9 and len(full) < len(names):
        open_ = [s for s in names if s not in full]
        share = rest / sum(weight[s] for s in open_)
        rest = 0
        for s in open_:
            target[s] += share * weight[s]
            if target[s] >= 3 * sizes[s]:
                rest += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                full.add(s)
    return target


def held(rows, texts):
    by = collections.defaultdict(int)
    size = {}
    for s, t in texts:
        size[s] = size.get(s, 0) + len(brute.WORD.findall(t or ""))
    want = plain_targets(size)
    for (s, _), r in zip(texts, rows, strict=True):
        assert r["source_size"] == size[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        by[s] += r["taken"]
    return by, want, size


def test_whole_table_is_near_its_targets(spark):
    docs = table(spark, SMALL, "documents").collect()
    got = {r.doc_id: r for r in mixing.mix(table(spark, SMALL, "documents")).collect()}
    by, want, size = held([got[d.doc_id] for d in docs], [(d.source, d.text) for d in docs])
    assert abs(sum(by.values()) - sum(size.values())) < 0.03 * sum(size.values())
    most = collections.defaultdict(int)
    for d in docs:
        most[d.source] = max(most[d.source], got[d.doc_id].size)
    for s in by:  # 50 documents each, of which one may hold a fifth of the words
        assert abs(by[s] - want[s]) < 0.03 * want[s] + most[s] / 2, (s, by[s], want[s])


def test_reruns_and_partitions_agree(spark):
    docs = table(spark, SMALL, "documents")
    a = sorted(map(tuple, mixing.mix(docs).collect()))
    b = sorted(map(tuple, mixing.mix(docs.repartition(13)).collect()))
    assert a == b


def test_odd_rows(spark):
    texts = [None, "", "a b c", "word " * 20_000, "x"]
    extra = [(7, "one two", None, "b", 1), (8, "one", None, "a", 1), (8, "one", None, "a", 1), (None, "q r", None, "a", 1)]
    extra += [(9, None, None, "empty", 0)]
    docs = brute.documents(spark, texts, extra)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts) + len(extra)
    by_id = {r.doc_id: r for r in rows if r.doc_id != 8}
    assert by_id[0]["size"] == 0 and by_id[9]["target"] == 0 and by_id[9]["taken"] == 0
    assert mixing.mix(brute.documents(spark, [])).count() == 0
    assert mixing.mix(brute.documents(spark, [None, ""])).count() == 2


def test_full_sources(spark):
    """Small sources give three times their size, exactly."""
    extra = [(i, "w " * (1 + i % 5), None, f"s{i // 8}", 0) for i in range(80)]
    docs = brute.documents(spark, [], [*extra, *[(1000 + i, "w " * 100, None, "zz", 0) for i in range(200)]])
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    held([got[i] for i, *_ in extra] + [got[1000 + i] for i in range(200)], [(e[3], e[1]) for e in extra] + [("zz", "w " * 100)] * 200)
    assert all(got[i].copies == 3 for i, *_ in extra)


def test_mixed_rows(spark):
    docs = table(spark, SMALL, "documents").withColumnRenamed("lang", "rows").withColumn("size", F.col("doc_id"))
    want = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    assert collections.Counter(r.doc_id for r in out.collect()) == want
    twice = brute.documents(spark, ["a", None], [(0, "a", None, None, 1)] * 11)
    # One source, so every row is expected once.
    assert collections.Counter(r.text for r in mixing.mixed_rows(twice).collect()) == {"a": 12, None: 1}
