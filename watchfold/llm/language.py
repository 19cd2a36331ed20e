"""Languages of texts by a linear-chain conditional random field over their words.

Words are labelled with languages. A word's score for a language adds weights of its
features: affixes, character n-grams, shape, and the share of each language in a lexicon
counted on the training rows. Transitions between languages are learned too, from
windows of the training rows of which some join two languages, so text that switches
language keeps a label for each part. Forward-backward sums give every word's
probabilities; the language of a text is the one with the highest mean over its words.

The model is fitted on at most ``FIT_ROWS`` rows of each language, a fixed number chosen
by hash, and broadcast: its size does not depend on the rows. Rows are labelled
in Arrow batches; there is no shuffle. In a batch, all texts' words stand in one array,
cut into segments of ``SEGMENT`` words, whose transfer matrices are multiplied up in
parallel, so long texts cost no more per word than short ones.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm.common import col
from watchfold.session import keep

FIT_ROWS = 240  # rows of a language for the fit
FIT_WORDS = 3000  # words of a row beyond which windows are taken from all over it
WINDOW = 30  # words of a training sequence
SWITCHED = 0.25  # share of training sequences that join two languages
BUCKETS = 1 << 15  # of hashed features
STEPS = 60
SEGMENT = 32
STEP_WORDS = 100_000  # words labelled at once
KNOWN = 100_000  # words whose scores a worker remembers
UNKNOWN = "und"

LONGEST = 32  # characters of a word
LETTERS = re.compile(r"[^\W\d_]{1,%d}" % LONGEST)


def words_of(text: str | None) -> list[str]:
    """Runs of letters and of numbers that are no digits; none if there is no letter at all.

    Runs of more than ``LONGEST`` characters, as of scripts without spaces, are cut into pieces.
    """
    words = LETTERS.findall(text) if text else []
    return words if any(map(str.isalpha, words)) or any(c.isalpha() for w in words for c in w) else []


def features(words: list[str]) -> np.ndarray:
    """Hashed features, a row per word: the word, affixes, n-grams with word ends, length, case.

    Columns that a word does not fill hold ``BUCKETS``.
    """
    low = [w.lower() for w in words]
    marked = ["^" + w + "$" for w in low]
    width = max(map(len, marked))
    left = np.frombuffer("".join(w.ljust(width, "\0") for w in marked).encode("utf-32-le"), np.uint32)
    right = np.frombuffer("".join(w.rjust(width, "\0") for w in marked).encode("utf-32-le"), np.uint32)
    left, right = (x.reshape(len(words), width).astype(np.uint64) for x in (left, right))
    out = []

    def put(kind: int, *codes: np.ndarray) -> None:
        """One feature for each place: a hash of the kind and of the characters, all of which have to be there."""
        h = np.full(codes[0].shape, kind, np.uint64)
        there = np.ones(codes[0].shape, bool)
        for c in codes:
            h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            there &= c > 0
        out.append(np.where(there, h % np.uint64(BUCKETS), BUCKETS).astype(np.int64).reshape(len(words), -1))

    for k in (1, 2, 3):
        put(k, *(left[:, i : width - k + 1 + i] for i in range(k)))
    for k in (2, 3, 4):
        if width > k + 1:
            put(10 + k, *(left[:, i] for i in range(1, k + 1)))
            put(20 + k, *(right[:, -1 - i] for i in range(1, k + 1)))
    whole = (left * (np.arange(width, dtype=np.uint64) * np.uint64(0x100000001B3) + np.uint64(7))).sum(axis=1)
    put(30, whole + np.uint64(1))
    put(31, np.array([min(len(w), 12) for w in low], np.uint64) + np.uint64(1))
    put(32, np.array([1 + w[0].isupper() for w in words], np.uint64))
    return np.concatenate(out, axis=1)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # BUCKETS + 1 x langs, the last of them zeros
    lexicon: dict[str, np.ndarray]  # log of the smoothed shares of languages
    lexicon_weight: np.ndarray
    step: np.ndarray  # log transitions
    start: np.ndarray
    place: dict[str, int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))

    def scores(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word; those of earlier words are remembered."""
        if len(self.place) >= KNOWN or not self.table.size:
            self.place, self.table = {}, np.empty((0, len(self.langs)))
        new = list({w for w in words if w not in self.place})
        for at in range(0, len(new), 2048):
            some = new[at : at + 2048]
            rows = self.weights[features(some)].sum(axis=1)
            none = np.zeros(len(self.langs))
            rows += self.lexicon_weight * np.array([self.lexicon.get(w.lower(), none) for w in some])
            self.place.update(zip(some, range(len(self.table), len(self.table) + len(some)), strict=True))
            self.table = np.concatenate([self.table, rows])
        return self.table[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]


def lexicon_of(texts: list[list[str]], labels: list[int], n: int) -> dict[str, np.ndarray]:
    counts: dict[str, np.ndarray] = defaultdict(lambda: np.full(n, 0.5))
    for words, k in zip(texts, labels, strict=True):
        for w in words:
            counts[w.lower()][k] += 1
    kept = {w: c for w, c in counts.items() if c.sum() >= 3 + n / 2}
    return {w: np.log(c / c.sum()) for w, c in kept.items()}


def sequences(texts: list[list[str]], labels: list[int], rng: np.random.Generator) -> tuple[list[list[str]], np.ndarray]:
    """Windows of equal length (shorter texts repeat their words) with a label per word."""
    words, tags = [], []
    for text, k in zip(texts, labels, strict=True):
        for _ in range(2 if len(text) <= FIT_WORDS else 4):
            at = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
            window = [text[(at + i) % len(text)] for i in range(WINDOW)]
            words.append(window)
            tags.append([k] * WINDOW)
    order = rng.permutation(len(words))
    for a, b in zip(order[: int(len(order) * SWITCHED)], order[::-1], strict=False):
        cut = int(rng.integers(5, WINDOW - 5))
        words[a] = words[a][:cut] + words[b][cut:]
        tags[a] = tags[a][:cut] + tags[b][cut:]
    return words, np.array(tags)


def forward_backward(emit: np.ndarray, step: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sequences x time x labels: probabilities of labels, expected transitions, log of the sums."""
    n, t, k = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e, a, total = np.exp(emit - top), np.exp(step), float(top.sum())
    f, b = np.empty_like(e), np.empty_like(e)
    f[:, 0] = np.exp(start) * e[:, 0]
    scale = np.empty((n, t))
    for i in range(t):
        if i:
            f[:, i] = (f[:, i - 1] @ a) * e[:, i]
        scale[:, i] = f[:, i].sum(axis=1)
        f[:, i] /= scale[:, i, None]
    b[:, -1] = 1
    pairs = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        right = b[:, i + 1] * e[:, i + 1] / scale[:, i + 1, None]
        pairs += (f[:, i].T @ right) * a
        b[:, i] = right @ a.T
    return f * b, pairs, total + float(np.log(scale).sum())


def fit(texts: list[str], langs: list[str], seed: int = 5) -> Model:
    """The model that maximises the likelihood of the windows' labels, by gradient ascent (Adam)."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    pairs = [(w, names.index(k)) for t, k in zip(texts, langs, strict=True) if (w := words_of(t))]
    k = len(names)
    flat = Model(names, np.zeros((BUCKETS + 1, k)), {}, np.ones(k), np.zeros((k, k)), np.zeros(k))
    if k < 2 or not pairs:
        return flat
    split, labels = [p[0] for p in pairs], [p[1] for p in pairs]
    # The lexicon comes from one half of the rows, weights from windows of all: else it would be trusted too much.
    lexicon = lexicon_of(split[::2], labels[::2], k)
    seqs, tags = sequences(split, labels, rng)
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for s in seqs for w in s))}
    ids = np.array([[vocabulary[w] for w in s] for s in seqs])
    feats = features(list(vocabulary))
    row = np.repeat(np.arange(len(feats)), feats.shape[1])
    bucket = feats.ravel()
    row, bucket = row[bucket < BUCKETS], bucket[bucket < BUCKETS]
    lex = np.array([lexicon.get(w.lower(), np.zeros(k)) for w in vocabulary])
    hot = np.eye(k)[tags]
    gold = np.zeros((k, k))
    np.add.at(gold, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    p = {"w": np.zeros((BUCKETS + 1, k)), "l": np.full(k, 0.3), "s": np.zeros((k, k)), "b": np.zeros(k)}
    m, v = ({n: np.zeros_like(x) for n, x in p.items()} for _ in range(2))
    for i in range(1, STEPS + 1):
        scores = np.stack([np.bincount(row, p["w"][bucket, j], len(feats)) for j in range(k)], axis=1) + p["l"] * lex
        prob, moves, _ = forward_backward(scores[ids], p["s"], p["b"])
        off = np.stack([np.bincount(ids.ravel(), (hot - prob)[:, :, j].ravel(), len(feats)) for j in range(k)], axis=1)
        grad = {
            "w": np.stack([np.bincount(bucket, off[row, j], BUCKETS + 1) for j in range(k)], axis=1) - 0.05 * p["w"],
            "l": (off * lex).sum(axis=0) - p["l"],
            "s": gold - moves - 0.05 * p["s"],
            "b": (hot[:, 0] - prob[:, 0]).sum(axis=0) - 0.05 * p["b"],
        }
        for n, g in grad.items():
            m[n] = 0.9 * m[n] + 0.1 * g
            v[n] = 0.999 * v[n] + 0.001 * g * g
            p[n] = p[n] + 0.1 * (m[n] / (1 - 0.9**i)) / (np.sqrt(v[n] / (1 - 0.999**i)) + 1e-8)
    return Model(names, p["w"], lexicon, p["l"], p["s"], p["b"])


def means(model: Model, texts: list[list[str]]) -> np.ndarray:
    """Mean probability of each language over the words of each text (none: zeros).

    Segments of all texts run side by side: first each segment's transfer matrix, then
    the vectors at its ends along the segments of a text, then the words inside.
    """
    k = len(model.langs)
    out = np.zeros((len(texts), k))
    sizes = np.array([len(t) for t in texts])
    some = np.flatnonzero(sizes)
    if not len(some) or k < 2:
        out[some] = 1.0
        return out
    emit = model.scores([w for i in some for w in texts[i]])
    emit = np.exp(emit - emit.max(axis=1, keepdims=True))
    a = np.exp(model.step - model.step.max())
    n = sizes[some]
    # A text's first word comes by a step from anywhere, taken back to the start's weights.
    emit[np.cumsum(n) - n] *= np.exp(model.start - model.start.max()) / a.mean(axis=0)
    segs = -(-n // SEGMENT)
    first = np.cumsum(segs) - segs  # first segment of each text
    text_of = np.repeat(np.arange(len(some)), segs)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    seg, at = np.repeat(first, n) + place // SEGMENT, place % SEGMENT
    # Places behind a text's end pass everything on unchanged.
    e = np.ones((SEGMENT, segs.sum(), k))
    live = np.zeros((SEGMENT, segs.sum()), bool)
    e[at, seg], live[at, seg] = emit, True

    def passed(x: np.ndarray, i: int, forward: bool) -> np.ndarray:
        """``x`` (segments x ... x labels) over place ``i``, scaled to a sum of one."""
        here = e[i].reshape(e[i].shape[0], *[1] * (x.ndim - 2), k)
        y = (x @ a) * here if forward else (x * here) @ a.T
        y = np.where(live[i].reshape(-1, *[1] * (x.ndim - 1)), y, x)
        return y / y.sum(axis=tuple(range(1, y.ndim)), keepdims=True)

    carry = np.broadcast_to(np.eye(k), (segs.sum(), k, k)).copy()
    for i in range(SEGMENT):
        carry = passed(carry, i, True)
    left, right = np.empty((segs.sum(), k)), np.empty((segs.sum(), k))
    left[first], right[first + segs - 1] = 1 / k, 1.0
    by_size = np.argsort(-segs, kind="stable")
    longest = int(segs.max())
    for j in range(longest - 1):
        on = by_size[: np.searchsorted(-segs[by_size], -(j + 1))]  # texts of more than j + 1 segments
        x = np.einsum("si,sij->sj", left[first[on] + j], carry[first[on] + j])
        left[first[on] + j + 1] = x / x.sum(axis=1, keepdims=True)
        last = first[on] + segs[on] - 1 - j
        x = np.einsum("sij,sj->si", carry[last], right[last])
        right[last - 1] = x / x.sum(axis=1, keepdims=True)
    f = np.empty_like(e)
    x = left
    for i in range(SEGMENT):
        f[i] = x = passed(x, i, True)
    total = np.zeros((segs.sum(), k))
    x = right
    for i in range(SEGMENT - 1, -1, -1):
        p = f[i] * x
        total += np.where(live[i][:, None], p / p.sum(axis=1, keepdims=True), 0)
        x = passed(x, i, False)
    np.add.at(out, some[text_of], total)
    out[some] /= n[:, None]
    return out


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that is never learned from; a null id hashes as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_on(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model of the non-null languages of the rows that are not held out.

    Of each language the ``FIT_ROWS`` rows of the lowest hash are taken: a first cut by
    each language's count leaves about twice as many, so only few rows are ever sorted.
    """
    rows = docs.select(col(doc_id).alias("id"), col(text).alias("text"), col(lang).alias("lang"))
    rows = rows.where(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("at", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)))
    counts = keep(rows.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    # Below the cut: twice the rows wanted, on average; all of them where a language has few.
    below = F.lit(float(1 << 40)) * (2 * FIT_ROWS + 40) / F.col("n")
    few = rows.join(counts, "lang").where(F.col("at") < below)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("at", "id", "text"))
    taken = few.withColumn("nth", nth).where(F.col("nth") <= FIT_ROWS).orderBy("lang", "nth")
    sample = taken.select("lang", "text").collect()
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


@lru_cache(maxsize=2)
def unpickled(blob: bytes) -> Model:
    return pickle.loads(blob)


def predict(df: DataFrame, model: Model, text: str = "text", name: str = "language") -> DataFrame:
    """``df`` with the struct ``name``: ``lang`` (und: null, or no letter) and ``score``, the mean probability."""
    shared = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    @F.pandas_udf("lang string, score double")
    def label(texts: pd.Series) -> pd.DataFrame:
        own = unpickled(shared.value)
        langs, scores = [], []

        def put(chunk: list[list[str]]) -> None:
            prob = means(own, chunk)
            best = prob.argmax(axis=1) if len(own.langs) else np.zeros(len(chunk), int)
            for words, p, k in zip(chunk, prob, best, strict=True):
                known = bool(words) and bool(own.langs)
                langs.append(own.langs[k] if known else UNKNOWN)
                scores.append(min(1.0, float(p[k])) if known else 0.0)

        chunk, n = [], 0
        for t in texts:
            words = words_of(t)
            chunk.append(words)
            n += len(words)
            if n >= STEP_WORDS:
                put(chunk)
                chunk, n = [], 0
        put(chunk)
        return pd.DataFrame({"lang": langs, "score": scores})

    return df.withColumn(name, label(col(text)))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: its id, ``held_out``, the predicted language and its score.

    Only the text decides. Repeated rows give equal rows; without any labelled row, or
    in a text without a letter, the language is ``und`` with score 0. An empty table gives
    an empty result; of equally probable languages the first in order is named. A text
    of any length is labelled whole, in segments. Further columns play no part.
    """
    model = fit_on(docs, doc_id, text, lang)
    rows = predict(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")), model)
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score"
    )


def known_language(docs: DataFrame, least: float = 0.0, text: str = "text") -> DataFrame:
    """``docs`` without those in no language: no letter, or a score below ``least``."""
    model = fit_on(docs)
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(text).alias("text"))
    kept = predict(rows, model).where((F.col("language.lang") != UNKNOWN) & (F.col("language.score") >= least))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
