import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL
from tests.llm import brute
from watchfold.llm import quality
from watchfold.llm.common import table


def plain_repeats(words):
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


def plain(text):
    text = text or ""
    words = brute.WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = {w: windows.count(w) for w in set(windows)} if len(windows) < 3000 else None
    hit = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if brute.WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    base = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit))
    return (*base, len(words) < 50 or 100 * len(hit) > 50 * len(words))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=25), max_size=6))
def test_repeats_equal_plain_search(texts):
    flat = np.array([w for t in texts for w in t], np.int64)
    owner = np.array([i for i, t in enumerate(texts) for _ in t], np.int64)
    got = quality.longest_repeats(flat, owner).tolist()
    assert got == [x for t in texts for x in plain_repeats(t)]
    spans = np.where(np.array(got) >= 2, np.array(got), 0) if got else np.zeros(0, np.int64)
    cover = quality.covered(spans, owner, len(texts)).tolist()
    want = []
    for t in texts:
        m = plain_repeats(t)
        want.append(len({j for i, k in enumerate(m) if k >= 2 for j in range(i, i + k)}))
    assert cover == want


def test_whole_table_and_odd_rows(spark):
    texts = [None, "", " \n \n", "a\na\n a\n\n", "# * <b>|", "x " * 2000, "one two three " * 40, "\x1f\xa0 a b c a b c"]
    docs = table(spark, SMALL, "documents")
    docs = docs.unionByName(brute.documents(spark, texts).selectExpr("doc_id - 100 doc_id", "text", "lang", "source", "n_chars"))
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    for d in docs.collect():
        r = got[d.doc_id]
        if len((d.text or "").split()) < 3000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(d.text)
        assert not (r.base_failed and r.kept)
    assert quality.judge(brute.documents(spark, [])).count() == 0


@pytest.mark.parametrize("times, kept", [(0, True), (1, True), (2, False), (3, False)])
def test_verdict(spark, times, kept):
    """A passage of 60 words repeated in a text of 400 others."""
    rng = np.random.default_rng(7)
    words = [f"w{x}" for x in rng.integers(0, 10**9, 460)]
    text = " ".join(words[:400] + words[400:] * 1 + words[400:] * times)
    row = quality.judge(brute.documents(spark, [text])).first()
    assert row.longest_repeat == (60 * times) and row.kept == kept
