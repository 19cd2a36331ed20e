import re

from tests.conftest import SMALL
from tests.llm import brute
from watchfold.llm import licenses
from watchfold.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    """The row of one text: phrases by comparing every place, notices by votes in dictionaries."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    base, labels, best = [], set(), 0.0
    for t in licenses.TEMPLATES:
        size, k = len(t.words), t.window
        if t.exact:
            places = [i for i in range(len(words) - size + 1) if tuple(words[i : i + size]) == t.words]
            base += [(i, t.label) for i in places if t.base]
            labels |= {t.label} if places else set()
            best = max(best, 1.0 if places else 0.0)
            continue
        runs = {}
        for i in range(len(words) - k + 1):
            for j in range(size - k + 1):
                if tuple(words[i : i + k]) == t.words[j : j + k]:
                    runs.setdefault(i - j, []).append((i, j))
        order = sorted((min(v)[0], d, max(v)[0] + k, {j for _, j in v}) for d, v in runs.items())
        matches = []
        for n, (start, d, stop, at) in enumerate(order):
            before = order[n - 1] if n else None
            if before and start - before[2] <= licenses.GAP and abs(d - before[1]) <= licenses.SHIFT:
                m = matches[-1]
                matches[-1] = (m[0], max(m[1], stop), m[2] | at)
            else:
                matches.append((start, stop, at))
        for start, stop, at in matches:
            score = len({p for j in at for p in range(j, j + k)}) / max(size, stop - start)
            if score >= licenses.LEAST:
                labels.add(t.label)
                best = max(best, score)
    at = [i for i, _ in base]
    return (
        len(words), len(base), min(at, default=None), max(at, default=None),
        ",".join(sorted({n for _, n in base})), ",".join(sorted(labels)), best,
    )


def found(df):
    return sorted((tuple(r) for r in licenses.scan(df).collect()), key=repr)


def expected(rows):
    return sorted(((r["doc_id"], *plain(r["text"])) for r in rows), key=repr)


def test_whole_table(spark):
    df = table(spark, SMALL, "documents")
    assert found(df) == expected(df.collect())


NOTICE = dict(licenses.NOTICES)["mit-grant"]
BSD = dict(licenses.NOTICES)["bsd"].split()


def test_reworded_notices(spark):
    texts = [
        NOTICE,
        NOTICE.replace("of charge", "of any charge at all").upper(),
        "aa bb " + NOTICE.replace("hereby ", "").replace(" ", ",\n") + " cc",
        " ".join(NOTICE.split()[:10]),
        " ".join(BSD[:8] + ["xx"] + BSD[9:]),
        " ".join(BSD[:11] + ["xx"] * 30 + BSD[11:]),
        " ".join(BSD[11:] + BSD[:11]),
        "General Public License " * 3,
        "mit mit license apache-license; the MIT\x00License",
        "all rights were reserved",
    ]
    df = brute.documents(spark, texts)
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [got[i].labels for i in range(7)] == ["mit-grant"] * 3 + ["", "bsd", "", ""]
    assert 0.75 <= got[1].score < 1 and got[0].score == 1
    assert (got[7].n_base, got[7].first_word, got[7].last_word) == (3, 0, 6)
    assert got[8].base_labels == "apache,mit" and got[8].n_base == 3 and got[9].labels == ""
    assert found(df) == expected(df.collect())


def test_long_texts_cut_into_stretches(spark, monkeypatch):
    monkeypatch.setattr(licenses, "STEP", 16)
    texts = [" ".join(["w"] * n + NOTICE.split() + ["v"] * 40 + ["mit", "license"] * 3) for n in range(0, 40, 3)]
    df = brute.documents(spark, texts + ["mit license", "a mit", "mit"])
    assert found(df) == expected(df.collect())


def test_odd_rows(spark):
    same = (3, "Released under the MIT License.", "en", "s", 5)
    extra = [same, same, (None, same[1], None, None, None), (None, None, None, None, None), (3, "x", None, None, None)]
    df = brute.documents(spark, ["", None, "  \n", "çé MIT ñ license mit license apache license", "MIT LICENSE" * 50], extra)
    more = df.selectExpr("*", "1 AS a", "'x' AS b", "map(1, 2) AS w", "2 AS pos", "text AS label", "0 AS template", "5 AS n_words")
    assert found(more) == expected(df.collect())
    assert licenses.scan(brute.documents(spark, [])).count() == 0


def test_spans_of_rows(spark):
    df = brute.documents(spark, ["so: " + NOTICE, "nothing", "MIT License and MIT License"])
    got = sorted((r.doc_id, r.label, r.base, r.start, r.stop) for r in licenses.license_spans(df).collect())
    assert got == [(0, "mit-grant", False, 1, 1 + len(NOTICE.split())), (2, "mit", True, 0, 2), (2, "mit", True, 3, 5)]


def test_hot_text_takes_the_broadcast_way(spark):
    rows = [(i, "Released under the MIT License." if i % 3 else f"text {i}", None, None, 1) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(df) == expected(df.collect())
