import itertools

import numpy as np

from tests.conftest import SMALL
from tests.llm import brute
from watchfold.llm import language
from watchfold.llm.common import table


def model(k=3, seed=1):
    rng = np.random.default_rng(seed)
    weights = rng.normal(size=(language.BUCKETS + 1, k)) / 3
    weights[-1] = 0
    return language.Model([f"l{i}" for i in range(k)], weights, {"ab": rng.normal(size=k)}, np.ones(k), rng.normal(size=(k, k)), rng.normal(size=k))


def test_probabilities_equal_sums_over_all_labellings(monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 3)
    m = model()
    rng = np.random.default_rng(2)
    texts = [["".join(rng.choice(list("abé"), 3)) for _ in range(n)] for n in (1, 2, 3, 4, 7, 0, 8)]
    got = language.means(m, texts)
    for text, row in zip(texts, got, strict=True):
        if not text:
            assert not row.any()
            continue
        e = m.scores(text)
        want, total = np.zeros(3), 0.0
        for tags in itertools.product(range(3), repeat=len(text)):
            s = m.start[tags[0]] + sum(e[i, t] for i, t in enumerate(tags)) + sum(m.step[a, b] for a, b in zip(tags, tags[1:], strict=False))
            total += np.exp(s)
            for t in tags:
                want[t] += np.exp(s) / len(text)
        assert np.allclose(row, want / total)
    prob, pairs, logz = language.forward_backward(m.scores(texts[4])[None], m.step, m.start)
    assert np.allclose(prob[0].mean(axis=0), got[4]) and np.isclose(pairs.sum(), 6)


def test_segments_do_not_matter(monkeypatch):
    m = model(4)
    text = [["abc", "bca", "xyz", "öäü"][i * i % 4] for i in range(1000)]
    a = language.means(m, [text, text[:10]])
    monkeypatch.setattr(language, "SEGMENT", 7)
    assert np.allclose(a, language.means(m, [text, text[:10]]))


def test_held_out_accuracy_and_reruns(spark):
    docs = table(spark, SMALL, "documents")
    rows = language.identify(docs).collect()
    lang = {d.doc_id: d.lang for d in docs.collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and 0.1 < len(held) / len(rows) < 0.3
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sorted(rows) == sorted(language.identify(docs.repartition(5)).collect())


def test_switched_text_and_odd_rows(spark):
    docs = table(spark, SMALL, "documents")
    by = {lang: " ".join(d.text for d in docs.where(f"lang = '{lang}'").limit(8).collect()) for lang in ("de", "en")}
    m = language.fit_on(docs)
    mixed = by["de"].split()[:60] + by["en"].split()[:20]
    odd = [None, "", "12 34 !? ²", " ".join(mixed), by["en"] * 20, "x"]
    got = [r.language for r in language.predict(brute.documents(spark, odd), m).orderBy("doc_id").collect()]
    assert [g.lang for g in got[:5]] == ["und", "und", "und", "de", "en"]
    assert [g.score for g in got[:3]] == [0, 0, 0] and 0.5 < got[3].score < 0.95
    assert language.identify(brute.documents(spark, [])).count() == 0
    assert {r.lang_pred for r in language.identify(brute.documents(spark, odd)).collect()} == {"und"}


def test_only_known_languages_stay(spark):
    docs = table(spark, SMALL, "documents").withColumnRenamed("source", "language")
    junk = brute.documents(spark, [None, "1 2 3"]).withColumnRenamed("source", "language")
    out = language.known_language(docs.unionByName(junk))
    assert out.columns == docs.columns and out.count() == docs.count()


def test_long_runs_count_whole():
    run = "".join(chr(ord("a") + i * i % 26) for i in range(100))
    assert language.words_of(f"x {run} y") == ["x", run[:32], run[32:64], run[64:96], run[96:], "y"]
    m = model()
    ends = lambda middle: language.means(m, [language.words_of("a" * 16 + middle + "a" * 16)])[0]
    assert not np.allclose(ends("b" * 64), ends("é" * 64))
