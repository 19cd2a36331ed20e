"""Quality of texts: counts, and repetition found with suffix arrays.

The words of a text are numbered and its suffixes sorted by prefix doubling. The common
prefix of a suffix and its neighbour in that order is the longest repeat that starts
there; intervals of such common prefixes are the maximal repeated substrings (of words).
The union of their spans gives the share of the text that is repeated, their length the
longest repeat. A text fails where either is above its limit.

Rows need nothing from each other: there is no shuffle. A batch's texts are sorted in
one array, each text with word numbers of its own, so no repeat reaches across texts.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchfold.llm.common import WORD, col

LEAST_REPEAT = 8  # words in a repeat that counts
MOST_COVERED = 0.45  # share of the words that repeats may cover
MOST_REPEAT = 100  # words in the longest repeat
LEAST_WORDS = 50
MOST_REPEATED_WINDOWS = 50  # percent of words in repeated windows of three
STEP_WORDS = 400_000  # words sorted at once

FIND_WORDS = re.compile(WORD).findall
NOT_SYMBOLS = re.compile(r"[^#*$%&|<>]+")
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long"


def longest_repeats(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each word the most words, from it on, that also stand elsewhere in the same text.

    ``words``: numbers of words; ``text``: the text of each, ascending.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    rank = np.unique(text * (int(words.max()) + 1) + words, return_inverse=True)[1].astype(np.int64)
    end = np.searchsorted(text, text, side="right")
    levels = []
    size = 1
    shared = np.flatnonzero(np.bincount(rank)[rank] > 1)
    # Suffixes that share `size` words with another, ranked by twice as many, until none are left.
    while len(shared):
        levels.append(rank)
        after = np.full(len(shared), -1, np.int64)
        inside = shared + size < end[shared]
        after[inside] = rank[shared[inside] + size]
        order = np.lexsort((after, rank[shared]))
        s, a, r = shared[order], after[order], rank[shared][order]
        new = np.r_[True, (r[1:] != r[:-1]) | (a[1:] != a[:-1])]
        head = np.r_[True, r[1:] != r[:-1]]
        # A rank is its old rank's first place plus the place in that group; old ranks are spread to make room.
        place = np.arange(len(s)) - np.maximum.accumulate(np.where(head, np.arange(len(s)), 0))
        start = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
        if size == 1:
            total = np.bincount(rank)
            rank = (np.cumsum(total) - total)[rank]
        rank = rank.copy()
        rank[s] = rank[s] + place[start]
        group = np.cumsum(new) - 1
        shared = s[np.bincount(group)[group] > 1]
        size *= 2
    # The order of all suffixes that share a word, and the common prefix of each two neighbours.
    out = np.zeros(n, np.int64)
    if not levels:
        return out
    some = np.flatnonzero(np.bincount(levels[0])[levels[0]] > 1)
    sa = some[np.argsort(rank[some], kind="stable")]
    p, q = sa[:-1].copy(), sa[1:].copy()
    common = np.zeros(len(p), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        fit = (p < n) & (q < n)
        same = np.zeros(len(p), bool)
        same[fit] = (levels[j][p[fit]] == levels[j][q[fit]]) & (text[p[fit]] == text[sa[:-1][fit]])
        same &= np.maximum(p, q) < end[sa[:-1]]
        common += same << j
        p, q = p + (same << j), q + (same << j)
    np.maximum.at(out, sa[:-1], common)
    np.maximum.at(out, sa[1:], common)
    return out


def covered(length: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Words of each text inside the union of the spans of ``length`` from each word on (0: none)."""
    at = np.arange(len(length))
    reach = np.maximum.accumulate(np.where(length > 0, at + length, 0)) if len(length) else at
    return np.bincount(text, reach > at, n_texts).astype(np.int64)


def measured(texts: list[str]) -> np.ndarray:
    """``COLUMNS`` of each text."""
    words = [FIND_WORDS(t) for t in texts]
    sizes = np.array([len(w) for w in words])
    out = np.zeros((len(texts), 7), np.int64)
    out[:, 0] = sizes
    for i, t in enumerate(texts):
        out[i, 1] = sum(map(len, words[i]))
        out[i, 2] = len(NOT_SYMBOLS.sub("", t))
        if "\n" in t:
            lines = [x for x in t.split("\n") if x and FIND_WORDS(x)]
            out[i, 3] = len(lines) - len(set(lines))
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    longest = longest_repeats(ids, text)
    out[:, 4] = covered(np.where(longest >= 3, 3, 0), text, len(texts))
    out[:, 5] = covered(np.where(longest >= LEAST_REPEAT, longest, 0), text, len(texts))
    np.maximum.at(out[:, 6], text, longest)
    return out


def measures(df: DataFrame, text: str = "text", name: str = "quality") -> DataFrame:
    """``df`` with the struct ``name`` of ``COLUMNS`` for the whole text (null: no words)."""

    @F.pandas_udf(COLUMNS)
    def count(texts: pd.Series) -> pd.DataFrame:
        found, held, n = [], [], 0
        for t in texts:
            held.append(t or "")
            n += len(held[-1]) // 5
            if n >= STEP_WORDS:
                found.append(measured(held))
                held, n = [], 0
        found.append(measured(held))
        return pd.DataFrame(np.concatenate(found), columns=[c.split()[0] for c in COLUMNS.split(", ")])

    return df.withColumn(name, count(col(text)))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its id, all counts, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails; repeated rows give equal rows; an empty
    table an empty result. A text of any length has one suffix array over its words; equal
    repeats count once for each place. Further columns play no part.
    """
    rows = measures(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")))
    rows = rows.select("doc_id", "quality.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_WINDOWS * F.col("n_words"))
    fine = (F.col("covered_words") <= MOST_COVERED * F.col("n_words")) & (F.col("longest_repeat") <= MOST_REPEAT)
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)
