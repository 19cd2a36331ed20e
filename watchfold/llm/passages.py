"""Passages that repeat across documents: MinHash banding of paragraphs.

A paragraph is a run of words cut where its own words say so: at the end of a line, and
of about every third short line, depending on the last two words of it and its neighbours; at
the end of a sentence, mostly, depending on its last two words; and after any two words, rarely, or more often where no
sentence has ended for a while, so that unpunctuated text is cut too. A passage copied
into another text, even into the middle of a line, is therefore cut alike there.

Each paragraph of ``LEAST_WORDS`` or more has a MinHash signature over its shingles of
five words, in ``BANDS`` bands of ``ROWS`` values: paragraphs of similarity 0.8 collide
in a band with a probability of ``1 - (1 - 0.8^2)^4`` = 0.983, equal ones always. A first
pass over the texts, stored in chunks of ``CHUNK`` documents, sends the keys of each chunk
to ranges of keys; those that collide come back to their chunks, where a second pass
gathers just the paragraphs that have one. Colliding
paragraphs are compared by their exact Jaccard similarity and joined into components;
in each, the first document's occurrences stay and the others are removed. Crowded bands are cut
into blocks, and each pair of blocks is a group of bounded size; of equal paragraphs
only one is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm.common import col, components, partitions, whole_groups
from watchfold.session import keep

SHINGLE = 5
LEAST = 0.8
LEAST_WORDS = 8
LEAST_SPAN = 16  # words of a run of repeated paragraphs that counts as a passage
BANDS, ROWS = 4, 2
CUT_ANY = 40  # one in so many pairs of words is a cut
CUT_BARE = 12  # the same where no sentence has ended within BARE words
BARE = 24
BLOCK = 1024  # paragraphs in a block of a crowded band
CHUNK = 2048  # documents whose keys are kept together
RANGE_BYTES = 32 << 20  # bytes of texts for each range of keys
STEP_WORDS = 200_000
KNOWN = 300_000  # words whose hashes a worker remembers

A = np.uint64(0x9E3779B97F4A7C15)
B = np.uint64(0xBF58476D1CE4E5B9)
MIX = [np.uint64(xxhash.xxh64_intdigest(bytes([i])) | 1) for i in range(BANDS * ROWS)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * B
    return x ^ (x >> np.uint64(27))


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


class Cut:
    """Paragraphs of several texts: arrays over all their words, and over the paragraphs."""

    def __init__(self, texts: list[bytes], known: Hashes):
        words, ends, long, sizes = [], [], [], []
        for t in texts:
            n = 0
            for line in t.split(b"\n"):
                if own := line.split():
                    words += own
                    n += len(own)
                    ends.append(len(words) - 1)
                    long.append(len(own) >= LEAST_WORDS)
            if n:
                long[-1] = True
            sizes.append(n)
        self.words = words
        n = len(words)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
        self.text = np.repeat(np.arange(len(texts)), sizes)
        self.origin = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes) if texts else np.empty(0, np.int64)
        two = mixed(h * A + np.r_[np.uint64(0), h[:-1]]) if n else h
        stop = np.fromiter((w[-1] in b".!?" for w in words), bool, n)
        # A sentence has three words at least: else text of words that all end so would have no paragraph.
        end = stop & ~np.r_[[False], stop[:-1]][:n] & ~np.r_[[False, False], stop[:-2]][:n]
        cut = end & (two % np.uint64(3) != 0) | (two % np.uint64(CUT_ANY) == 0)
        since = np.arange(n) - np.maximum.accumulate(np.where(stop, np.arange(n), -1)) if n else np.empty(0, np.int64)
        cut |= (since >= BARE) & (two % np.uint64(CUT_BARE) == 0)
        # Of the ends of short lines those whose last two words have a smaller hash than those of the lines around.
        ends, long = np.array(ends, np.int64), np.array(long, bool)
        rank = np.where(long, np.uint64(0), two[ends])
        edge = np.full(1, ~np.uint64(0))
        cut[ends[long | (rank < np.r_[edge, rank[:-1]][: len(rank)]) & (rank <= np.r_[rank[1:], edge][: len(rank)])]] = True
        last = np.flatnonzero(cut)
        first = np.r_[0, last[:-1] + 1] if len(last) else last
        # A pair of words over a line's end says nothing about the place: its cut is the line's own.
        wide = last - first + 1 >= LEAST_WORDS
        self.first, self.size = first[wide], (last - first + 1)[wide]
        # Shingles that start at each word; those inside a paragraph are its first size - 4.
        s = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            s[: n - k] = mixed(s[: n - k] * A + h[k:]) if n > k else s[: n - k]
        self.shingles = s

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Content hashes (as signed numbers) and band keys of the paragraphs."""
        m = len(self.first)
        if not m:
            return np.empty(0, np.int64), np.empty((0, BANDS), np.int64)
        edges = np.empty(2 * m, np.int64)
        edges[::2], edges[1::2] = self.first, self.first + self.size - SHINGLE + 1
        padded = np.r_[self.shingles, np.uint64(0)]
        low = np.stack([np.minimum.reduceat(mixed(padded * k), edges)[::2] for k in MIX], axis=1)
        keys = np.full((m, BANDS), 0, np.uint64)
        for b in range(BANDS):
            key = np.full(m, b + 1, np.uint64)
            for r in range(ROWS):
                key = mixed(key * A + low[:, b * ROWS + r])
            keys[:, b] = key
        content = np.add.reduceat(mixed(padded * MIX[0]), edges)[::2]
        # The order of shingles counts too: a chain over first, last and number.
        content = mixed(content * A + self.shingles[self.first] + np.uint64(3) * self.shingles[edges[1::2] - 1] + self.size.astype(np.uint64))
        return content.view(np.int64), keys.view(np.int64)


def chunks(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows of a batch in steps of about ``STEP_WORDS`` words."""
    upto = np.cumsum(rows["text"].map(lambda t: len(t) // 6 + 1).to_numpy()) // STEP_WORDS if len(rows) else []
    for _, step in rows.groupby(upto, sort=False) if len(rows) else ():
        yield step


def packed(keys: np.ndarray, chunk: int, parts: int) -> pd.DataFrame:
    """Rows (part, chunk, once, again): a chunk's keys of each range as bytes, those that occur again beside."""
    key, n = np.unique(keys, return_counts=True)
    part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    edge = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, np.int64)
    rows = [
        (part[a], chunk, key[a:b][n[a:b] == 1].tobytes(), key[a:b][n[a:b] > 1].tobytes())
        for a, b in zip(edge, edge[1:], strict=False)
    ]
    return pd.DataFrame(rows, columns=["part", "chunk", "once", "again"])


def by_chunk(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """Steps of rows of one chunk each."""
    for batch in batches:
        for chunk, rows in batch.groupby("chunk", sort=False):
            for step in chunks(rows):
                yield int(chunk), step


def colliding_keys(docs: DataFrame) -> DataFrame:
    """(chunk, keys): for each chunk of ``docs``, its keys that more than one paragraph of any text has, as bytes.

    Keys travel as packed arrays, one for each range of keys and stretch of a chunk in a
    task: eight bytes a key, and a crowded one is moved once for each chunk. The number
    of ranges grows with the texts, so a range's keys fit a worker at every size.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    parts = max(partitions(docs.sparkSession), -(-size // RANGE_BYTES))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, held, at = Hashes(), [], None
        for chunk, step in by_chunk(batches):
            if at is not None and chunk != at:
                yield packed(np.concatenate(held), at, parts)
                held = []
            at = chunk
            held.append(Cut(list(step["text"]), known).keys()[1].ravel().view(np.uint64))
        if held:
            yield packed(np.concatenate(held), at, parts)

    def again(frame: pd.DataFrame) -> pd.DataFrame:
        once = [np.frombuffer(b, np.uint64) for b in frame["once"]]
        more = [np.frombuffer(b, np.uint64) for b in frame["again"]]
        key, n = np.unique(np.concatenate([*once, np.empty(0, np.uint64)]), return_counts=True)
        met = np.union1d(key[n > 1], np.concatenate([*more, np.empty(0, np.uint64)]))
        out = []
        for chunk, a, b in zip(frame["chunk"], once, more, strict=True):
            mine = np.concatenate([a, b])
            mine = mine[np.isin(mine, met, assume_unique=True)]
            if len(mine):
                out.append((chunk, mine.tobytes()))
        return pd.DataFrame(out, columns=["chunk", "keys"])

    rows = docs.select("chunk", "text").mapInPandas(pack, "part long, chunk long, once binary, again binary")
    return rows.groupBy("part").applyInPandas(again, "chunk long, keys binary")


def occurrences(docs: DataFrame, colliding: DataFrame | None) -> DataFrame:
    """Paragraphs with a key that collides (None: all): doc_id, doc, start, size, h, its keys k0, k1 ... and words.

    The keys of a chunk come before its texts in the same partition, so a worker holds
    the keys of one chunk at a time.
    """

    everything = colliding is None

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, at, held, lit = Hashes(), None, [], None
        for batch in batches:
            if everything:
                batch = batch.assign(chunk=0, keys=None)
            for chunk, rows in batch.groupby("chunk", sort=False):
                if chunk != at:
                    at, held, lit = chunk, [], None
                held += [np.frombuffer(k, np.int64) for k in rows["keys"] if k is not None]
                rows = rows[rows["text"].notna()]
                if not len(rows) or not (everything or held):
                    continue
                if lit is None and not everything:
                    lit = np.unique(np.concatenate(held))
                for step in chunks(rows):
                    yield from paragraphs(step, Cut(list(step["text"]), known), lit)

    kind = dict(docs.dtypes)["doc_id"]
    bands = ", ".join(f"k{b} long" for b in range(BANDS))
    schema = f"doc_id string, doc long, start long, size long, h long, {bands}, words binary"
    # As a string on the way: pandas has no null among whole numbers.
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    if not everything:
        some = colliding.withColumn("doc", F.lit(-1).cast("long"))
        rows = rows.select("chunk", "doc", "doc_id", "text").unionByName(some, allowMissingColumns=True)
        rows = rows.repartition(partitions(docs.sparkSession), "chunk").sortWithinPartitions("chunk", "doc")
    return rows.mapInPandas(work, schema).withColumn("doc_id", F.col("doc_id").cast(kind))


def paragraphs(step: pd.DataFrame, cut: Cut, lit: np.ndarray | None) -> Iterator[pd.DataFrame]:
    """The paragraphs of some texts of which a key is among the sorted keys ``lit``."""
    h, keys = cut.keys()
    if not len(h):
        return
    if lit is None:
        hit = np.arange(len(h))
    else:
        place = np.minimum(np.searchsorted(lit, keys), len(lit) - 1)
        hit = np.flatnonzero((lit[place] == keys).any(axis=1))
    if len(hit):
        own = cut.text[cut.first[hit]]
        yield pd.DataFrame(
            {
                "doc_id": step["doc_id"].to_numpy()[own],
                "doc": step["doc"].to_numpy()[own],
                "start": cut.first[hit] - cut.origin[cut.first[hit]],
                "size": cut.size[hit],
                "h": h[hit],
                **{f"k{b}": keys[hit, b] for b in range(BANDS)},
                "words": [b" ".join(cut.words[cut.first[i] : cut.first[i] + cut.size[i]]) for i in hit],
            }
        )


def similar(frame: pd.DataFrame) -> pd.DataFrame:
    """Verified links (a, b) of whole groups (key, left, right): compared until everything similar is connected."""
    out = []
    sets: dict[int, frozenset] = {}

    def shingles(h: int, words: bytes) -> frozenset:
        if h not in sets:
            w = words.split()
            sets[h] = frozenset(zip(*(w[i:] for i in range(SHINGLE)), strict=False))
        return sets[h]

    for _, group in frame.groupby(["key", "left", "right"], sort=False):
        ids, words = group["h"].to_numpy(), group["words"].to_numpy()
        held, asks = group["held"].to_numpy(), group["asks"].to_numpy()
        parent = list(range(len(ids)))

        def root(i: int, parent: list[int] = parent) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        # The latest links come first: in a crowd of copies, most are found at once.
        recent = [i for i in range(len(ids)) if held[i]]
        for i in range(len(ids)):
            if not asks[i]:
                continue
            a = shingles(ids[i], words[i])
            tried: set[int] = set()
            for j in recent:
                if j == i or root(j) == root(i):
                    continue
                b = shingles(ids[j], words[j])
                small, large = sorted((len(a), len(b)))
                if small >= LEAST * large and (both := len(a & b)) >= LEAST * (len(a) + len(b) - both):
                    parent[max(root(i), root(j))] = min(root(i), root(j))
                    out.append((ids[i], ids[j]))
                    tried.add(j)
            if tried:
                recent = [*tried, *(j for j in recent if j not in tried)]
        if len(sets) > 50_000:
            sets.clear()
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def paragraph_links(found: DataFrame) -> DataFrame:
    """Links (a, b) between the contents ``h`` of paragraphs that collide and are similar."""
    # Each content once, without its words, which only those need that meet another one.
    keys = [f"k{b}" for b in range(BANDS)]
    contents = keep(found.groupBy("h").agg(*[F.first(k).alias(k) for k in keys]), "paragraph-contents")
    members = contents.select(F.explode(F.array(*keys)).alias("key"), "h")
    crowds = members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    crowds = keep(crowds.select("key", F.ceil(F.col("n") / BLOCK).alias("cut")), "crowded-bands")
    members = keep(members.join(crowds, "key"), "band-members")
    some = found.select("h", "doc", "words").join(members.select("h").distinct(), "h", "left_semi")
    # Dealt anew by document, so that a content that many share is combined before it meets in one place.
    some = some.repartition(partitions(found.sparkSession), "doc")
    words = keep(some.groupBy("h").agg(F.first("words").alias("words")), "paragraph-words")
    rows = members.join(words, "h").withColumn("own", F.pmod(F.xxhash64("h", F.lit(5)), F.col("cut")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cut") - 1)))
    rows = rows.select(
        "key",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
        "h",
        "words",
        (F.col("own") <= F.col("other")).alias("held"),
        (F.col("own") >= F.col("other")).alias("asks"),
    )
    keys = ["key", "left", "right"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, keys, 5000):
            yield similar(frame)

    rows = rows.repartition(partitions(found.sparkSession), *keys).sortWithinPartitions(*keys, "h")
    return rows.mapInPandas(compare, "a long, b long")


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per passage that also stands in another document; documents without one have no row.

    doc_id; ``start`` and ``n_words`` of the passage in words of the text; its
    ``component_id`` and ``first_doc_id``, the document of its first occurrence (smallest
    id, null last); ``removed``: false in that document. What only repeats inside one
    document is none. Null and empty texts have no passage. Repeated rows are documents
    of their own; of equal ids the first stored row comes first. An empty table gives an
    empty result. A text of any length is cut whole. Further columns play no part.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).cast("binary").alias("text"))
    # Stored, so that both passes see the same numbers.
    rows = keep(rows.withColumn("doc", F.monotonically_increasing_id()), "numbered-texts")
    inside = F.col("doc").bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.withColumn("chunk", F.col("doc") - inside + F.floor(inside / CHUNK))
    found = keep(occurrences(rows, keep(colliding_keys(rows), "colliding-keys")), "paragraphs")
    roots = keep(components(paragraph_links(found)), "paragraph-components")
    light = found.select("doc_id", "doc", "start", "size", "h")
    named = light.join(roots, light["h"] == roots["node"], "left").withColumn("root", F.coalesce("root", "h"))
    named = keep(named.select("doc_id", "doc", "start", "size", "root"), "named-paragraphs")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc", "start")
    firsts = named.groupBy("root").agg(F.min(order).alias("first"), F.min("doc").alias("a"), F.max("doc").alias("b"))
    firsts = keep(firsts.where("a < b").select("root", "first"), "first-paragraphs")
    hits = named.join(firsts, "root").withColumn("removed", F.col("doc") != F.col("first.doc"))
    # Neighbouring paragraphs form one passage, where the two follow each other in another document too.
    by = Window.partitionBy("doc", "removed").orderBy("start")
    gap = F.col("start") - F.lag(F.col("start") + F.col("size")).over(by)
    hits = keep(hits.withColumn("prior", F.when(gap < LEAST_WORDS, F.lag("root").over(by))), "repeated-paragraphs")
    twos = hits.where("prior is not null").groupBy("prior", "root").agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
    twos = keep(twos.where("a < b").select(F.col("prior").alias("p"), F.col("root").alias("r")), "repeated-neighbours")
    runs = hits.join(twos, (F.col("prior") == F.col("p")) & (F.col("root") == F.col("r")), "left")
    runs = runs.withColumn("run", F.sum(F.when(F.col("p").isNull(), 1).otherwise(0)).over(by))
    spans = runs.groupBy("doc", "removed", "run").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        (F.max(F.col("start") + F.col("size")) - F.min("start")).alias("n_words"),
        F.min("root").alias("component_id"),
        F.min("first")["doc_id"].alias("first_doc_id"),
    )
    spans = spans.where(F.col("n_words") >= LEAST_SPAN)
    return spans.select("doc_id", "start", "n_words", "component_id", "first_doc_id", "removed")
