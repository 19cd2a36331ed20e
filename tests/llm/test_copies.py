from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import brute
from watchfold.llm import copies
from watchfold.llm.common import table
from watchfold.llm.simhash import fingerprints


def shingled(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def expected(rows):
    sets = {i: shingled(t) for i, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return sorted(set(brute.joined(ids, pairs).values()))


def texts():
    """Texts of 200 words, each with a copy that is similar to about 0.86, and one that is not to 0.8."""
    out = []
    for n in range(12):
        words = [f"w{n}x{i}" for i in range(200)]
        near, far = list(words), list(words)
        for i in (20, 80, 140):
            near[i] = f"new{n}"
        for i in range(10, 200, 20):
            far[i] = f"other{n}"
        out += [" ".join(words), " ".join(near), " ".join(far).upper()]
    return out


def test_stage_finds_similarity_of_four_fifths(spark):
    rows = [*texts(), "a b c", "A b  c", "a b d", "", None]
    docs = brute.documents(spark, rows)
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == expected(list(enumerate(rows)))


def test_crowded_bands_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(copies, "BLOCK", 4)
    base = [f"w{i}" for i in range(100)]
    rows = [" ".join([*base[:i], f"n{i}", *base[i + 1 :]]) for i in range(0, 100, 3)] + [" ".join(base[:60])]
    docs = brute.documents(spark, rows, [(None, rows[0], None, None, 1), (0, rows[0], "en", None, 2)]).withColumnRenamed("source", "h")
    out = copies.drop_similar(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == expected(list(enumerate(rows)))
    assert copies.drop_similar(brute.documents(spark, [])).count() == 0
    lone = copies.drop_similar(brute.documents(spark, [], [(None, "no id", None, None, None)] * 2))
    assert [r.doc_id for r in lone.collect()] == [None]


def test_whole_table(spark):
    docs = table(spark, SMALL, "documents")
    got = sorted(r.doc_id for r in copies.drop_similar(docs).collect())
    assert got == expected([(d.doc_id, d.text) for d in docs.collect()])


def test_kept_rows(spark):
    texts = ["a b c d", "A b c d", "something else here", None, ""]
    extra = [(0, "a b c d", "en", "s", 7), (None, "nobody", None, None, None), (9, "a b c d", "x", None, 7)]
    docs = brute.documents(spark, texts, extra).withColumnRenamed("source", "fp")
    out = copies.drop_similar(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(0, "a b c d"), (2, texts[2]), (3, None), (None, "nobody")], key=repr)


def test_fingerprints_give_candidates(spark):
    """Copies that no band holds are found by SimHash and BK-trees; those that are not similar stay."""
    base = [f"w{i}" for i in range(400)]
    rows = [" ".join(base), " ".join([*base[:200], "new", *base[201:]]), " ".join(f"v{i}" for i in range(400)), "a b c", "a b d"]
    docs = brute.documents(spark, rows)
    prints = fingerprints(docs.select("doc_id", "text")).select("doc_id", "fp", copies.signatures(F.col("text").cast("binary")).alias("s"))
    alone = F.transform("s.keys", lambda k: F.xxhash64(k, "s.h"))  # no two contents share a band
    prints = prints.select("doc_id", "fp", "s.h", alone.alias("keys")).cache()
    assert copies.copy_links(docs, prints.drop("fp"), "text").isEmpty()
    h = {r.doc_id: r.h for r in prints.collect()}
    links = copies.copy_links(docs, copies.fingerprint_keys(prints), "text").collect()
    assert {frozenset(r) for r in links} == {frozenset((h[0], h[1]))}
