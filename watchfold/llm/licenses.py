"""Licences that texts name or quote, by diagonal voting.

Every window of k words of a text (k of each template) is hashed and joined with the
window positions of the templates; a join row counts only if the words themselves are
equal. The rows vote for diagonals: text position minus template position. All windows
of an exact phrase on one diagonal are a place where its words stand consecutively. For
longer notices, which people reword, votes on neighbouring diagonals that follow each
other in the text are merged, so that words left out or put in do not break a match,
and the span is verified: its share of template words found by equal windows, over the
longer of template and span, has to reach ``LEAST``.

Templates are a fixed list, the only thing broadcast. Texts are cut into stretches of
``STEP`` words, so a text of any length is joined in pieces; only rows that match a
template are shuffled, never a text.

Defined results: null and empty texts have no words, no places, null positions, empty
labels and score 0. Repeated rows give equal rows, null ids too: rows are gathered by a
128-bit hash of the text, on which alone the result depends. Equal labels of several
spans count once. An empty table gives an empty result. Further columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchfold.llm.common import attach, col
from watchfold.session import keep

STEP = 1000
SHIFT = 8  # diagonals of one match differ by at most this from one run of votes to the next
GAP = 8  # words without a vote between two runs of one match
LEAST = 0.75

#: Phrases that have to stand word by word, with the labels they give.
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
#: Public licence notices.
NOTICES = [
    ("all-rights-reserved", "all rights reserved"),
    ("mit-notice", "released under the mit license"),
    (
        "mit-grant",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0-header",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license",
    ),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl-header",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    (
        "lgpl-header",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
        "general public license as published by the free software foundation",
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: Words in a window: of exact phrases, and of notices of at least that many words.
SHORT, LONG = 2, 4
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    base: bool

    @property
    def window(self) -> int:
        return LONG if len(self.words) >= LONG and not self.base else SHORT

    @property
    def exact(self) -> bool:
        return self.window == SHORT


TEMPLATES = [Template(n, tuple(p.split()), True) for n, p in PHRASES]
TEMPLATES += [Template(n, tuple(p.split()), False) for n, p in NOTICES]


def words_of(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), _LETTERS, _LETTERS.lower())
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def rolling(df: DataFrame, words: str) -> DataFrame:
    """``df`` with the hashes of the windows that start at each word: ``h2`` of two and ``h4`` of four of ``words``.

    Each is made of hashes half as wide; windows that would run over the end are to be left out.
    """
    df = df.withColumn("h1", F.transform(words, lambda x: F.xxhash64(x)))
    df = df.withColumn("h2", F.transform("h1", lambda x, i: F.xxhash64(x, F.get("h1", i + 1))))
    return df.withColumn("h4", F.transform("h2", lambda x, i: F.xxhash64(x, F.get("h2", i + 2))))


def template_windows(df: DataFrame, templates: list[Template]) -> DataFrame:
    """(h, gram, template, tpos) of every window of every template, and a row that any text's own mark meets."""
    rows = []
    for number, t in enumerate(templates):
        rows += [(number, i, list(t.words[i : i + t.window])) for i in range(len(t.words) - t.window + 1)]
    table = df.sparkSession.createDataFrame(rows, "template int, tpos int, gram array<string>")
    h = F.when(F.size("gram") == SHORT, F.get("h2", F.lit(0))).otherwise(F.get("h4", F.lit(0))).alias("h")
    mark = df.sparkSession.createDataFrame([(-1, 0, [], 0)], "template int, tpos int, gram array<string>, h long")
    return rolling(table, "gram").select("template", "tpos", "gram", h).unionByName(mark)


def votes(docs: DataFrame, templates: list[Template]) -> DataFrame:
    """(doc_id, a, b, n_words, template, tpos, pos): every equal window, and per text one row of template -1."""
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"), words_of(F.col("text")).alias("w")
    )
    n = F.size("w")

    def stretch(at: Column) -> Column:
        return F.struct(at.alias("at"), F.slice("w", at + 1, STEP + LONG - 1).alias("w"))

    places = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(STEP))
    own = ["doc_id", "a", "b", "n_words"]
    rows = rows.select(*own[:3], n.alias("n_words"), F.explode(F.transform(places, stretch)).alias("s"))
    rows = rolling(rows.select(*own, "s.at", "s.w"), "w")
    # Windows of two words start at STEP words of a stretch at most; those of four fit as they are.
    short, long = F.least(F.greatest(F.size("w") - 1, F.lit(0)), F.lit(STEP)), F.greatest(F.size("w") - 3, F.lit(0))
    mark = F.when(F.col("at") == 0, F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    windows = F.concat(F.slice("h2", F.lit(1), short), F.slice("h4", F.lit(1), long), mark)
    rows = rows.select(*own, "at", "w", short.alias("short"), long.alias("long"), F.posexplode(windows).alias("i", "seen"))
    # The words come along by reference as far as the join, where those of the few equal hashes are compared
    # (the equality is wrapped, or else it would become a part of the key, made for every window).
    here = F.when(F.col("i") < F.col("short"), F.col("i")).otherwise(F.col("i") - F.col("short"))
    width = F.when(F.col("i") < F.col("short"), SHORT).when(F.col("i") < F.col("short") + F.col("long"), LONG).otherwise(0)
    known = F.broadcast(template_windows(docs, templates))
    same = F.coalesce(F.slice("w", here + 1, width) == F.col("gram"), F.lit(False))
    met = rows.join(known, (F.col("seen") == F.col("h")) & same)
    return met.select(*own, "template", "tpos", (F.col("at") + here).alias("pos"))


def spans(found: DataFrame, templates: list[Template]) -> DataFrame:
    """(a, b, label, base, start, stop, score): verified spans of words; ``stop`` is exclusive."""
    fields = "template int, label string, base boolean, exact boolean, size int, width int"
    facts = [(i, t.label, t.base, t.exact, len(t.words), t.window) for i, t in enumerate(templates)]
    facts = F.broadcast(found.sparkSession.createDataFrame(facts, fields))
    diagonals = (
        found.where("template >= 0")
        .groupBy("a", "b", "template", (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .agg(F.collect_set("tpos").alias("at"), F.min("pos").alias("start"), F.max("pos").alias("last"))
        .join(facts, "template")
        .withColumn("stop", F.col("last") + F.col("width"))
    )
    whole = F.size("at") == F.col("size") - F.col("width") + 1
    exact = diagonals.where(F.col("exact") & whole)
    exact = exact.select("a", "b", "label", "base", "start", "stop", F.lit(1.0).alias("score"))

    # Neighbouring diagonals: the next run of votes starts soon after the last one and is shifted little.
    run = Window.partitionBy("a", "b", "template").orderBy("start", "diagonal")
    near = (F.col("start") - F.lag("stop").over(run) <= GAP) & (
        F.abs(F.col("diagonal") - F.lag("diagonal").over(run)) <= SHIFT
    )
    runs = diagonals.where(~F.col("exact")).withColumn("new", F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1))
    runs = runs.withColumn("match", F.sum("new").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    # A template's positions are few, so each match's set of them is small.
    merged = runs.groupBy("a", "b", "template", "match").agg(
        F.first("label").alias("label"),
        F.first("size").alias("size"),
        F.first("width").alias("width"),
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        F.array_distinct(F.flatten(F.collect_set("at"))).alias("at"),
    )
    covered = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + F.col("width") - 1))))
    score = F.size(covered) / F.greatest(F.col("size"), F.col("stop") - F.col("start"))
    merged = merged.withColumn("score", score).where(F.col("score") >= LEAST)
    return exact.unionByName(merged.select("a", "b", "label", F.lit(False).alias("base"), "start", "stop", "score"))


def license_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[Template] | None = None
) -> DataFrame:
    """(doc_id, label, base, start, stop, score) of every verified span of every row, in words from 0."""
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    found = keep(votes(rows, templates or TEMPLATES), "license-votes")
    texts = found.where("template < 0").select("doc_id", "a", "b")
    return texts.join(spans(found, templates or TEMPLATES), ["a", "b"]).drop("a", "b")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    found = keep(votes(rows, TEMPLATES), "license-votes")

    def labels(only: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(only, F.col("label")))), ",")

    per_text = keep(
        spans(found, TEMPLATES)
        .groupBy("a", "b")
        .agg(
            F.count_if("base").alias("n_base"),
            F.min(F.when(F.col("base"), F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(F.col("base"), F.col("start"))).cast("long").alias("last_word"),
            labels(F.col("base")).alias("base_labels"),
            labels(F.lit(True)).alias("labels"),
            F.max("score").alias("score"),
        ),
        "license-labels",
    )
    texts = found.where("template < 0").select("doc_id", "a", "b", F.col("n_words").cast("long").alias("n_words"))
    out = attach(texts, per_text, ["a", "b"])
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _rows_sql() -> str:
    rows = []
    for number, t in enumerate(TEMPLATES):
        for i in range(len(t.words) - t.window + 1):
            gram = " ".join(t.words[i : i + t.window])
            rows.append(
                f"({number}, '{t.label}', {t.base}, {t.exact}, {len(t.words)}, {t.window}, {i}, '{gram}')"
            )
    return ", ".join(rows)


#: The query in DuckDB's SQL.
SQL = f"""
WITH t(template, label, base, exact, size, width, tpos, gram) AS (VALUES {_rows_sql()}),
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
starts AS (
  SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS pos
  FROM w, (SELECT unnest([{SHORT}, {LONG}]) AS k) AS widths WHERE len(w) >= k),
votes AS (
  SELECT g.doc_id, g.pos, t.*
  FROM (SELECT doc_id, pos, array_to_string(w[pos + 1 : pos + k], ' ') AS gram FROM starts) g JOIN t ON g.gram = t.gram),
diagonals AS (
  SELECT doc_id, template, label, base, exact, size, width, pos - tpos AS diagonal, count(*) AS n, min(pos) AS start,
    max(pos) + width AS stop
  FROM votes GROUP BY doc_id, template, label, base, exact, size, width, pos - tpos),
near AS (
  SELECT *, CASE WHEN start - lag(stop) OVER run <= {GAP} AND abs(diagonal - lag(diagonal) OVER run) <= {SHIFT}
    THEN 0 ELSE 1 END AS new
  FROM diagonals WHERE NOT exact WINDOW run AS (PARTITION BY doc_id, template ORDER BY start, diagonal)),
runs AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY start, diagonal
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS match FROM near),
covered AS (
  SELECT doc_id, template, match, count(DISTINCT place) AS n
  FROM (SELECT r.doc_id, r.template, r.match, unnest(range(v.tpos, v.tpos + v.width)) AS place
        FROM runs r JOIN votes v ON r.doc_id = v.doc_id AND r.template = v.template AND r.diagonal = v.pos - v.tpos)
  GROUP BY doc_id, template, match),
merged AS (
  SELECT r.doc_id, r.label, false AS base, min(r.start) AS start,
    any_value(c.n) / CAST(greatest(any_value(r.size), max(r.stop) - min(r.start)) AS DOUBLE) AS score
  FROM runs r JOIN covered c ON r.doc_id = c.doc_id AND r.template = c.template AND r.match = c.match
  GROUP BY r.doc_id, r.template, r.match, r.label),
spans AS (
  SELECT doc_id, label, base, start, CAST(1 AS DOUBLE) AS score FROM diagonals WHERE exact AND n = size - width + 1
  UNION ALL SELECT doc_id, label, base, start, score FROM merged WHERE score >= {LEAST}),
texts AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
    max(start) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM spans GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, CAST(0 AS DOUBLE)) AS score
FROM w LEFT JOIN texts ON w.doc_id = texts.doc_id"""
