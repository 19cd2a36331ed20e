"""Near copies for the pipeline: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates are the groups of op9, fingerprints (SimHash) that BK-trees connect. They hold
the closest copies only: at similarity 0.8 two fingerprints differ in some 10 of 64 bits,
often more. So there are further candidates from MinHash: ``BANDS`` bands of ``ROWS``
values, which pairs of similarity 0.8 share with a probability of
``1 - (1 - 0.8^4)^16`` = 0.9998, more similar ones more surely. All candidates are
compared by their exact similarity before components are formed. Of bands with the same
documents one is searched; crowded ones are cut into blocks, and each pair of blocks is
a group of bounded size. A text of fewer than five words is a copy only of an equal one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold.llm.common import col, components, own_name, partitions, whole_groups
from watchfold.llm.passages import A, Hashes, mixed
from watchfold.llm.simhash import fingerprints, near_groups
from watchfold.session import keep

WIDTH = 5  # words in a shingle
LEAST = 0.8
BANDS, ROWS = 16, 4
BLOCK = 512  # documents in a block of a crowded band
STEP_SHINGLES = 200_000
MIX = [np.uint64(xxhash.xxh64_intdigest(b"copy" + bytes([i])) | 1) for i in range(BANDS * ROWS)]


def content(words: list[bytes]) -> int:
    """Number of the words in lower case, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(words))).view(np.int64))


def shingles(words: list[bytes], known: Hashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles; none below ``WIDTH`` words."""
    n = len(words) - WIDTH + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    s = np.zeros(n, np.uint64)
    for k in range(WIDTH):
        s = mixed(s * A + h[k : k + n])
    return np.unique(s)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Keys of the bands of sets that are not empty, a row for each."""
    every = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    low = [np.minimum.reduceat(mixed(every * k), first) for k in MIX]
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(sets), b + 1, np.uint64)
        for r in range(ROWS):
            key = mixed(key * A + low[b * ROWS + r])
        keys[:, b] = key
    return keys.view(np.int64)


@F.pandas_udf(T.LongType())
def contents(texts: pd.Series) -> pd.Series:
    return pd.Series([content((t or b"").lower().split()) for t in texts], dtype="int64")


@F.pandas_udf(T.StructType().add("h", T.LongType()).add("keys", T.ArrayType(T.LongType())))
def signatures(texts: pd.Series) -> pd.DataFrame:
    known, hs, keys = Hashes(), [], [[] for _ in range(len(texts))]
    held, at, n = [], [], 0
    for i, t in enumerate(texts):
        words = (t or b"").lower().split()
        hs.append(content(words))
        if len(own := shingles(words, known)):
            held.append(own)
            at.append(i)
            n += len(own)
        if held and (n >= STEP_SHINGLES or i == len(texts) - 1):
            for j, k in zip(at, band_keys(held), strict=True):
                keys[j] = k
            held, at, n = [], [], 0
    if held:
        for j, k in zip(at, band_keys(held), strict=True):
            keys[j] = k
    return pd.DataFrame({"h": hs, "keys": keys}).astype({"h": "int64"})


def similar(frame: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Links (a, b) of whole groups (key, left, right): compared until everything similar is connected."""
    known = Hashes()
    for _, group in frame.groupby(["key", "left", "right"], sort=False):
        ids, held, asks = (group[c].to_numpy() for c in ("h", "held", "asks"))
        sets = [shingles(w.lower().split(), known) for w in group["words"]]
        size = np.array([len(s) for s in sets])
        label = np.arange(len(ids))  # of the component so far
        for i in np.flatnonzero(asks):
            small, large = np.minimum(size, size[i]), np.maximum(size, size[i])
            open_ = held & (small >= LEAST * large)
            while len(rest := np.flatnonzero(open_ & (label != label[i]))):
                j = rest[-1]
                open_[j] = False
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both >= LEAST * (size[i] + size[j] - both):
                    yield int(ids[i]), int(ids[j])
                    label[label == label[j]] = label[i]


def fingerprint_keys(prints: DataFrame) -> DataFrame:
    """``prints`` (h, keys, fp) with one more key: the group of fingerprints that the content belongs to."""
    near = near_groups(prints.where(F.size("keys") > 0).select("fp", F.col("h").alias("doc_id")))
    key = F.array(F.xxhash64("component_id", F.lit(11)))
    # A text without shingles has no keys, and is in no group.
    keys = F.when(F.size("keys") > 0, F.concat("keys", key)).otherwise(F.col("keys"))
    return prints.join(near, "fp", "left").withColumn("keys", keys).drop("component_id", "fp")


def copy_links(docs: DataFrame, prints: DataFrame, text: str) -> DataFrame:
    """Links (a, b) between the contents of ``prints`` (h, keys) that are similar; ``docs`` has their texts."""
    members = prints.select("h", F.explode("keys").alias("key"))
    crowds = members.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("h", F.lit(3))).alias("x"), F.bit_xor(F.xxhash64("h", F.lit(9))).alias("y")
    )
    crowds = crowds.where("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    crowds = keep(crowds.select("key", F.ceil(F.col("n") / BLOCK).alias("cut")), "crowded-copies")
    members = keep(members.join(crowds, "key"), "copy-members")
    words = docs.select(contents(col(text).cast("binary")).alias("h"), col(text).cast("binary").alias("words"))
    words = words.join(members.select("h").distinct(), "h", "left_semi")
    words = keep(words.groupBy("h").agg(F.first("words").alias("words")), "copy-words")
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
        for frame in whole_groups(batches, keys, 1000):
            yield pd.DataFrame(list(similar(frame)), columns=["a", "b"]).astype("int64")

    rows = rows.repartition(partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys, "h")
    return rows.mapInPandas(compare, "a long, b long")


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component of near copies: that with the smallest id, then the smallest values.

    Null and empty texts are equal; null ids count only where a component has no other.
    """
    h = own_name(docs, "h")
    binary = col(text).cast("binary")
    prints = fingerprints(docs.select(col(doc_id).alias("id"), binary.alias("text")))
    prints = prints.select("id", "fp", signatures("text").alias("s")).select("id", "fp", "s.h", "s.keys")
    prints = prints.groupBy("h").agg(F.min("id").alias("low"), F.first("keys").alias("keys"), F.first("fp").alias("fp"))
    prints = keep(prints, "document-contents")
    roots = keep(components(copy_links(docs, fingerprint_keys(prints), text)), "copy-components")
    named = prints.select("h", "low").join(roots, prints["h"] == roots["node"], "left")
    named = keep(named.select("h", "low", F.coalesce("root", "h").alias("root")), "copy-roots")
    first = F.min(F.struct(F.col("low").isNull().alias("none"), "low", "h")).alias("first")
    win, low = own_name(docs, "win"), own_name(docs, "low")
    best = named.groupBy("root").agg(first).select(F.col("first.low").alias(low), F.col("first.h").alias(win))
    best = keep(best, "kept-ids")
    rows = docs.withColumn(h, contents(binary))
    chosen = rows.join(best, (col(h) == col(win)) & col(doc_id).eqNullSafe(col(low)), "left_semi")
    rest = [c for c in docs.columns if c != doc_id]
    every = F.struct(*[col(c) for c in rest])
    # Values without an order of their own (maps) are ordered by a hash of the row as JSON.
    ordered = [col(c) for c in rest if "map<" not in dict(docs.dtypes)[c] and dict(docs.dtypes)[c] != "variant"]
    order = F.struct(*ordered, F.sha2(F.to_json(every), 256).alias("json"))
    one = chosen.groupBy(col(h), col(doc_id)).agg(F.min_by(every, order).alias("rest"))
    return one.select(*[col(c) if c == doc_id else F.col("rest")[c].alias(c) for c in docs.columns])
