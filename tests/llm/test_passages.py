import collections
import random

from tests.conftest import SMALL
from tests.llm import brute
from watchfold.llm import passages
from watchfold.llm.common import components, table


def sharing(texts, size):
    """Documents with a run of ``size`` words that also stands in another one, by all windows."""
    seen = collections.defaultdict(set)
    for i, t in texts.items():
        words = brute.WORD.findall(t or "")
        for k in range(len(words) - size + 1):
            seen[tuple(words[k : k + size])].add(i)
    return {i for docs in seen.values() if len(docs) > 1 for i in docs}


def test_whole_table_against_all_windows(spark):
    docs = table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = passages.repeated_passages(docs).collect()
    found = {r.doc_id for r in rows}
    assert len(found & sharing(texts, 50)) >= 0.98 * len(sharing(texts, 50))
    assert len(found - sharing(texts, 12)) <= 0.01 * len(texts)
    kept = {(r.component_id, r.doc_id) for r in rows if not r.removed}
    assert all(r.doc_id == r.first_doc_id for r in rows if not r.removed) and kept
    assert all(r.first_doc_id < r.doc_id for r in rows if r.removed)


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_near_paragraphs_equal_plain_comparison(spark, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", 16)
    rng = random.Random(3)
    lines = []
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for _ in range(9):
            other = list(words)
            for _ in range(rng.randrange(3)):
                other[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
            lines.append(" ".join(other))
    df = brute.documents(spark, lines).selectExpr("doc_id", "cast(text as binary) text", "doc_id doc")
    found = passages.occurrences(df, None).cache()
    words = {r.h: bytes(r.words).decode() for r in found.collect()}
    roots = {r.node: r.root for r in components(passages.paragraph_links(found)).collect()}
    h = sorted(words)
    pairs = [(a, b) for a in h for b in h if a < b and len(words[a]) > 40 < len(words[b]) and jaccard(words[a], words[b]) >= 0.8]
    want = brute.joined(h, pairs)
    wrong = sum(roots.get(x, x) != want[x] for x in want)
    assert len(set(want.values())) < len(want) and wrong <= 0.04 * len(want)


def text_of(rng, n):
    return " ".join(f"v{rng.randrange(10**7)}" + ("." if i % 9 == 8 else "") for i in range(n))


def test_odd_rows(spark):
    rng = random.Random(8)
    shared, mine = text_of(rng, 70), [text_of(rng, 200) for _ in range(6)]
    texts = [None, "", mine[0], mine[1] + " " + shared + " " + text_of(rng, 90), text_of(rng, 33) + " " + shared]
    texts += [" ".join([mine[2]] * 3), "a b c d e f g h. " * 5000, "x" * 40_000]
    extra = [(None, mine[3], None, None, 1), (None, mine[3], None, None, 1), (2, mine[0], "en", "s", 1)]
    docs = brute.documents(spark, texts, extra).withColumnRenamed("lang", "h").withColumnRenamed("source", "doc")
    rows = passages.repeated_passages(docs).collect()
    assert {r.doc_id for r in rows} == {2, 3, 4, None}
    assert {(r.doc_id, r.removed) for r in rows} == {(2, False), (2, True), (3, False), (4, True), (None, False), (None, True)}
    assert [r.first_doc_id for r in rows if r.doc_id == 4] == [3] * sum(r.doc_id == 4 for r in rows)
    assert max(r.n_words for r in rows if r.doc_id == 4) >= 45
    assert passages.repeated_passages(brute.documents(spark, [])).count() == 0


def planted(rng, style, size):
    """A passage of ``size`` words: in lines of seven words, without punctuation, or as prose."""
    words = [f"s{rng.randrange(10**7)}" for _ in range(size)]
    if style == "lines":
        return "\n".join(" ".join(words[i : i + 7]) for i in range(0, size, 7))
    if style == "prose":
        words = [w + ("." if rng.random() < 0.1 else "") for w in words]
    return " ".join(words)


def test_passages_of_any_layout(spark, monkeypatch):
    """Passages of 80 words set among other words at any place: in short lines, bare, and as prose."""
    monkeypatch.setattr(passages, "CHUNK", 16)
    rng = random.Random(5)
    texts, pairs = [], {}
    for style in ("lines", "bare", "prose"):
        for _ in range(40):
            shared = planted(rng, style, 80)
            pairs[len(texts)] = style
            for _ in range(2):
                around = [text_of(rng, rng.randrange(3, 60)), text_of(rng, rng.randrange(3, 60))]
                texts.append(f"{around[0]} {shared} {around[1]}")
    texts += [text_of(rng, 150) for _ in range(30)]
    rows = passages.repeated_passages(brute.documents(spark, texts)).collect()
    found = {r.doc_id for r in rows}
    share = collections.Counter(style for i, style in pairs.items() if {i, i + 1} <= found)
    assert share["prose"] >= 36 and share["lines"] >= 34 and share["bare"] >= 34, share
    assert not found & set(range(240, 270))
