"""Main texts of web pages: page differencing between neighbours in URL order.

A page is read into lines, one per block element. Lines outside the article are aligned
with those of the page with the nearest URL path on the same host by longest common
subsequence, and what both pages share is deleted: menus, notices and the like repeat
from page to page. Pages of a host with the same set of lines are copies and no neighbours of each
other: the nearest path with another set counts. What is left of menus, adverts, forms, comments and so on is known by
its element, class or role. Lines inside an ``article`` or ``main`` element are never
deleted for being shared: copies of an article on one host share all of them. Where a
page has such an element, its lines are the text; elsewhere, all that is left.

Neighbours come from one order of all distinct (host, path), cut into ranges, so that a
host may hold most pages; ranges hand their first and last row to each other. Only line
hashes are moved, not pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold.llm.common import col, ordered_parts
from watchfold.session import keep

# Elements and words of classes, ids and roles.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
SKIPPED = set("head nav footer aside form script style noscript template iframe object svg math canvas select button textarea dialog audio video".split())
RAW = set("script style textarea title noscript template iframe".split())
ARTICLE = {"article", "main"}
SKIPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar complementary footer contentinfo "
    "comment comments respond replies disqus cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe signup login search form share sharing social related widget".split()
)
HEADER_WORDS = set("header masthead topbar".split())
#: First parts of names that say what a page has, not what an element is; last parts that only say that it is a box.
STATES = set("has have with without no not is category tag hide show".split())
BOXES = set("area bar block body box buttons container content icons inner items links list outer posts section slot unit wrap wrapper".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*>|([^<]++|<)""", re.S
)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+))""", re.I)
WORDS = re.compile(r"[a-z0-9]+")
HAS_ARTICLE = re.compile(r"<(?:article|main)(?=[\s/>])|\b(?:role|itemprop)\s*=", re.I)

UNDECIDED, ARTICLE_LINE, KNOWN = 0, 1, 2


def is_named(value: str, words: set[str]) -> bool:
    """Whether a name of ``value`` is one of the words, or a form like ``site-footer`` or ``ad-box-3`` of one.

    Names such as ``has-sidebar``, ``category-social`` and ``comments-open`` are none.
    """
    for name in value.lower().split():
        parts = [p for p in WORDS.findall(name) if not p.isdigit()]
        while len(parts) > 1 and parts[-1] in BOXES:
            parts.pop()
        if parts and parts[-1] in words and (len(parts) == 1 or parts[0] not in STATES):
            return True
    return False


def role_of(tag: str, attributes: str, in_article: bool) -> int:
    """KNOWN for what is not text of the page, ARTICLE_LINE for its container, else UNDECIDED."""
    if tag in SKIPPED or tag == "header" and not in_article:
        return KNOWN
    main = tag in ARTICLE
    named = False
    for name, *values in NAMED.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        words = set(WORDS.findall(value.lower()))
        main |= name == "role" and bool(words & ARTICLE) or name == "itemprop" and "articlebody" in words
        if tag in HEADINGS and name == "id":  # made of the heading's own words
            continue
        named |= is_named(value, SKIPPED_WORDS) or not in_article and is_named(value, HEADER_WORDS)
    if main:
        return ARTICLE_LINE
    return KNOWN if named and tag not in ("html", "body") else UNDECIDED


def lines_of(html: str) -> tuple[list[str], list[int]]:
    """Texts of the blocks in page order, white space as one space, and what each is.

    Articles in what is not text, such as cards in a sidebar, are not text either, unless
    the page has no other article.
    """
    lines, kinds = blocks_of(html, False)
    if ARTICLE_LINE not in kinds and KNOWN in kinds and HAS_ARTICLE.search(html):
        return blocks_of(html, True)
    return lines, kinds


def blocks_of(html: str, lifted: bool) -> tuple[list[str], list[int]]:
    """``lines_of``; ``lifted``: what an article stands in does not count."""
    lines: list[str] = []
    kinds: list[int] = []
    buffer: list[str] = []
    stack: list[tuple[str, int]] = []
    depth = [0, 0, 0]  # open elements of each role
    around = 0  # of the elements that are not text, those that do not count

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                lines.append(text)
                kinds.append(KNOWN if depth[KNOWN] > around else ARTICLE_LINE if depth[ARTICLE_LINE] else UNDECIDED)

    def close(to: int) -> None:
        nonlocal around
        for _, role in stack[to:]:
            depth[role] -= 1
        del stack[to:]
        if not depth[ARTICLE_LINE]:
            around = 0

    at, size = 0, len(html)
    last = html.rfind(">")
    while at < size:
        m = TOKEN.match(html, at) if at <= last or html[at] != "<" else None
        if m is None:  # a tag that never ends
            buffer.append("<")
            at += 1
            continue
        at = m.end()
        if m[4] is not None:
            buffer.append(m[4])
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag not in INLINE:
            flush()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if any(stack[j][1] for j in range(i, len(stack))):
                        flush()
                    close(i)
                    break
            continue
        if tag in VOID or m[3].endswith("/") and tag not in RAW and tag not in INLINE | ARTICLE:
            continue
        if tag == "body":
            close(0)
        elif tag not in INLINE:  # a block ends an open paragraph, an item the item before
            ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in ends.get(tag, ()):
                    close(i)
                elif stack[i][0] not in INLINE:
                    break
        role = role_of(tag, m[3], depth[ARTICLE_LINE] > 0)
        if role:
            flush()
        if lifted and role == ARTICLE_LINE and not depth[ARTICLE_LINE]:
            around = depth[KNOWN]
        stack.append((tag, role))
        depth[role] += 1
        if tag in RAW:  # up to its own end tag, whatever stands there
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            inner_end = end.start() if end else size
            if tag in ("title", "textarea"):
                buffer.append(html[at:inner_end])
            at = inner_end
    flush()
    return lines, kinds


def shared_lines(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by bit vectors."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    x, y = a[low : len(a) - high], b[low : len(b) - high]
    places: dict = {}
    for j, v in enumerate(y):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows, v = [full], full
    for w in x:  # a zero bit at j: the subsequence grows with y[j]
        u = v & places.get(w, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    hit, i, j = [], len(x), len(y)
    while i and j:
        if x[i - 1] == y[j - 1]:
            hit.append(low + i - 1)
            i, j = i - 1, j - 1
            continue
        mask = (1 << j) - 1
        if (rows[i - 1] & mask).bit_count() == (rows[i] & mask).bit_count():
            i -= 1
        else:
            j -= 1
    return [*range(low), *reversed(hit), *range(len(a) - high, len(a))]


def split_url(df: DataFrame) -> DataFrame:
    """``df`` with ``host`` and ``path`` of ``url``: lower case host, path without query and fragment."""
    host = F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_extract("url", r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)
    return df.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


OUTER = T.StructType().add("own", T.ArrayType(T.LongType())).add("open", T.ArrayType(T.BooleanType()))


@F.pandas_udf(OUTER)
def outer_lines(html: pd.Series) -> pd.DataFrame:
    """Hashes of the lines outside the article, and whether each is undecided."""
    own, undecided = [], []
    for h in html:
        lines, kinds = lines_of(h or "")
        has = ARTICLE_LINE in kinds
        out = [(xxhash.xxh64_intdigest(t, 1) - (1 << 63), k == UNDECIDED and not has) for t, k in zip(lines, kinds, strict=True) if k != ARTICLE_LINE]
        own.append([x for x, _ in out])
        undecided.append([x for _, x in out])
    return pd.DataFrame({"own": own, "open": undecided})


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def deleted_lines(own: pd.Series, undecided: pd.Series, near: pd.Series) -> pd.Series:
    """Places, among all lines outside the article, of undecided lines that both pages have."""
    out = []
    for a, o, b in zip(own, undecided, near, strict=True):
        copy = set(a) == set(b)  # as pages of one path can be of another path's
        out.append([] if copy else [i for i in shared_lines(list(a), list(b)) if o[i]])
    return pd.Series(out)


@F.pandas_udf(T.StringType())
def text_of(html: pd.Series, deleted: pd.Series) -> pd.Series:
    """Lines of the article, or those that are left outside, joined by line feeds."""
    out = []
    for h, gone in zip(html, deleted, strict=True):
        lines, kinds = lines_of(h or "")
        if ARTICLE_LINE in kinds:
            left = [t for t, k in zip(lines, kinds, strict=True) if k == ARTICLE_LINE]
        else:
            drop = set() if gone is None else {int(g) for g in gone}
            left = [t for i, (t, k) in enumerate(zip(lines, kinds, strict=True)) if k == UNDECIDED and i not in drop]
        out.append("\n".join(left))
    return pd.Series(out)


def nearest(paths: DataFrame) -> DataFrame:
    """``paths`` (host, path, own: one row each) with ``near``: ``own`` of the path before it on its
    host, for a host's first path of the one behind it, null for a single one."""
    parts = ordered_parts(paths, ["host", "path"])
    ends = parts.groupBy("part").agg(
        F.min(F.struct("host", "path", "own")).alias("first"), F.max(F.struct("host", "path", "own")).alias("last")
    )
    ends = sorted(ends.collect(), key=lambda r: r["part"])  # two rows for each range
    before = {b["part"]: (a["last"]["host"], list(a["last"]["own"])) for a, b in zip(ends, ends[1:], strict=False)}
    behind = {a["part"]: (b["first"]["host"], list(b["first"]["own"])) for a, b in zip(ends, ends[1:], strict=False)}

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, prior, held = None, (None, None), None

        def row(r, next_host, next_own):
            return (r.host, r.path, prior[1] if prior[0] == r.host else next_own if next_host == r.host else None)

        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if part is None:
                    part, prior = r.part, before.get(r.part, (None, None))
                if held is not None:
                    out.append(row(held, r.host, r.own))
                    prior = (held.host, held.own)
                held = r
            if out:
                yield pd.DataFrame(out, columns=["host", "path", "near"])
        if held is not None:
            yield pd.DataFrame([row(held, *behind.get(part, (None, None)))], columns=["host", "path", "near"])

    return parts.mapInPandas(neighbours, "host string, path string, near array<long>")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, url, ``text`` and ``n_chars``.

    A null html is empty and has an empty text; a null url is a host of its own. Repeated
    rows give equal rows: pages of one host and path are no neighbours of each other. An
    empty table gives an empty result. A page of any length is read whole, by one worker;
    of equally near neighbours the first in order of path is taken. Further columns play
    no part.
    """
    rows = pages.select(col(page_id).alias("page_id"), col(url).alias("url"), col(html).alias("html"))
    rows = rows.withColumn("print", F.sha2(F.concat_ws("\0", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))), 256))
    outer = split_url(rows).select("print", "host", "path", outer_lines("html").alias("o"))
    outer = keep(outer.select("print", "host", "path", "o.own", "o.open").where(F.size("own") > 0), "outer-lines")
    paths = outer.groupBy("host", "path").agg(F.min(F.struct("print", "own", "open")).alias("p"))
    # Copies differ in paths, and maybe in menus and adverts that are known by name.
    kept = F.transform(F.filter(F.arrays_zip("p.own", "p.open"), lambda x: x["open"]), lambda x: x["own"])
    lines = F.array_sort(F.array_distinct(F.when(F.size(kept) > 0, kept).otherwise(F.col("p.own"))))
    paths = keep(paths.select("host", "path", "p.own", F.xxhash64(lines).alias("lines")), "page-paths")
    groups = paths.groupBy("host", "lines").agg(F.min(F.struct("path", "own")).alias("p"))
    near = nearest(groups.select("host", "p.path", "p.own")).where(F.col("near").isNotNull())
    heads = groups.select("host", "lines", F.col("p.path").alias("path"))
    near = keep(near.join(heads, ["host", "path"]).select("host", "lines", "near"), "nearest-pages")
    asked = outer.where(F.exists("open", lambda o: o)).dropDuplicates(["print"])
    asked = asked.join(paths.select("host", "path", "lines"), ["host", "path"])
    found = asked.join(near, ["host", "lines"]).select("print", deleted_lines("own", "open", "near").alias("deleted"))
    found = keep(found.where(F.size("deleted") > 0), "deleted-lines")
    out = rows.join(found, "print", "left").select("page_id", "url", text_of("html", "deleted").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
