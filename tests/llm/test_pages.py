import html as H

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL
from watchfold.llm import pages
from watchfold.llm.common import table

SCHEMA = "page_id long, url string, html string"


def plain_lcs(a, b):
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            size[i][j] = size[i - 1][j - 1] + 1 if x == y else max(size[i - 1][j], size[i][j - 1])
    return size[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_alignment_equals_plain_search(a, b):
    got = pages.shared_lines(a, b)
    assert got == sorted(set(got)) and len(got) == plain_lcs(a, b)
    rest = iter(b)
    assert all(a[i] in rest for i in got)


def texts(spark, rows):
    return {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_elements(spark):
    art = "<article><header><h1>T &amp; t</h1></header><p>One <b>two</b>\n three<p>Four<ul><li>five<li>six</ul><p class='ad'>buy<p>x &lt;b&gt; &eacute;&nbsp;y<div class='comments'><p>me too</div></article>"
    page = f"<html><head><title>no</title></head><body><nav><a>n</a></nav><script>var t='</p><p>x';</script><div id='cookie-notice'><p>we</p></div>{art}<aside>s</aside><form>f</form><footer>z</footer>"
    got = texts(spark, [(1, "http://a/b", page), (2, None, None), (3, "", ""), (4, "x", "just text < 3 & more"), (5, "x", "<p>a<p>b<br>c<!-- d -->e<td"), (6, "y", "<p>" * 3000 + "deep")])
    assert got[1] == "T & t\nOne two three\nFour\nfive\nsix\nx <b> é y"
    assert got[2] == got[3] == "" and got[4] == "just text < 3 & more" and got[6] == "deep"
    assert got[5] == "a\nb\nce<td"


def test_shared_lines_go_and_copies_stay(spark):
    page = lambda t: f"<div>Our site</div><p>Menu one</p><p>{t}</p><p>All rights</p>"
    rows = [(i, f"https://h.example/{i:03}", page(f"story {i}")) for i in range(50)]
    rows += [(100, "https://h.example/010?x=1", page("story 10")), (100, "https://h.example/010", page("story 10"))]
    rows += [(200, "https://alone.example/a", page("alone"))]
    rows += [(300 + i, f"https://c.example/{i}", "<nav>n</nav><article><p>the very same</p></article>") for i in range(5)]
    got = texts(spark, rows)
    assert all(got[i] == f"story {i}" for i in range(50)) and got[100] == "story 10"
    assert got[200] == "Our site\nMenu one\nalone\nAll rights"
    assert all(got[300 + i] == "the very same" for i in range(5))
    assert len(rows) == pages.extract(spark.createDataFrame(rows, SCHEMA)).count()


def test_whole_table(spark):
    """Pages of the table are generated: their article is one element without further markup rules."""
    rows = table(spark, SMALL, "pages")
    got = {r.page_id: r for r in pages.extract(rows).collect()}
    for p in rows.collect():
        inner = p.html.partition("<article>")[2].partition("</article>")[0]
        for tag in ("</h1>", "<p>", "</p>", "<br>"):
            inner = inner.replace(tag, "\0")
        parts = [" ".join(H.unescape(x).split()) for x in inner.replace("<h1>", "").replace("<b>", "").replace("</b>", "").split("\0")]
        assert got[p.page_id].text == "\n".join(x for x in parts if x)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)
    assert pages.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_names_that_only_mention_a_menu():
    for open_, close in (
        ("<article class='post hentry category-social'>", "</article>"),
        ("<main class='content has-sidebar'>", "</main>"),
        ("<div class='layout with-sidebar'><article>", "</article></div>"),
        ("<article class='comments-open'>", "</article>"),
        ("<div class='search'><main>", "</main></div>"),
        ("<form><article class='social'>", "</article></form>"),
    ):
        page = f"<body><nav>n</nav>{open_}<h2 id='search-trends'>Trends</h2><p>Text</p><div class='share-box'>Share</div>{close}<p>after</p>"
        lines, kinds = pages.lines_of(page)
        assert [t for t, k in zip(lines, kinds, strict=True) if k == pages.ARTICLE_LINE] == ["Trends", "Text"], open_
    lines, kinds = pages.lines_of("<article><p>Text</article><div class='related-posts related'><article>card</article></div><div class='site-footer'>f</div>")
    assert kinds == [pages.ARTICLE_LINE, pages.KNOWN, pages.KNOWN]


def test_copies_at_different_paths_stay(spark):
    page = lambda t, ad="": f"<div>Our site</div><nav>{ad}</nav><p>{t}</p><p>All rights</p>"
    rows = [(i, f"https://h.example/{i:03}", page("the same", f"ad {i}")) for i in range(20)]
    rows += [(20, "https://h.example/020", page("another"))]
    rows += [(30 + i, f"https://c.example/{i}", page("only copies")) for i in range(3)]
    got = texts(spark, rows)
    assert {got[i] for i in range(20)} == {"the same"} and got[20] == "another"
    assert {got[30 + i] for i in range(3)} == {"Our site\nonly copies\nAll rights"}
