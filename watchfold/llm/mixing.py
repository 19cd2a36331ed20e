"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected ``target / size of the source`` times. These
expectations are summed up along an order of the source's documents, one random offset
is added, and a document is emitted once for each whole number that its stretch of the
sum crosses. In the order of size, the words taken come near the target with much less
spread than independent draws have. A few very long documents can still put a small source
far off, so the offset is the best of ``OFFSETS`` random ones: that whose words come nearest.

Expectations are whole numbers of 2^-24 copies, so that sums are exact in any order and
every run takes the same documents. A source may hold most rows: the order is cut into
ranges (``ordered_parts``), each range is summed in its own task, and what each hands to
the next is one row per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm.common import WORD, col, ordered_parts
from watchfold.session import keep

WEIGHTS = (5, 2, 1)
MOST = 3  # copies of a document, and times its size that a source gives
ONE = 1 << 24  # parts of a copy
SEED = 17
OFFSETS = 32  # random offsets of which a source takes the best


def words_of(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``sizes`` (source, source_size: long) with ``target``: shares of the whole, by weight.

    Sources in the order of their code points, null last, have the weights in turn. No
    target exceeds ``most`` times its source's size; what it would be above is shared
    again by weight until none is. That is a common level per weight: sources with the
    lowest caps per weight are full, the others at the level. One row per source, so the
    windows over all of them are small.
    """
    whole = Window.partitionBy(F.lit(0))
    by_name = whole.orderBy(F.col("source").asc_nulls_last())
    rank = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    # Caps per weight, ascending; before: what fuller sources have taken.
    by_cap = whole.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "_left": F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)),
            "_weight": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)),
        }
    )
    rows = rows.withColumn("_level", F.col("_left") / F.col("_weight"))
    # The level is that of the first source that is not full; from there on it only falls.
    level = F.max(F.when(F.col("cap") >= F.col("_level") * F.col("weight"), F.col("_level"))).over(whole)
    target = F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))
    return rows.withColumn("target", target).select("source", "source_size", "target")


def sums(frames: Iterator[pd.DataFrame], key: str, value: str, carry: dict) -> Iterator[pd.DataFrame]:
    """Frames of a sorted range with ``before``: the sum of ``value`` over earlier rows of the same key."""
    last, running = None, 0
    for frame in frames:
        if not len(frame):
            continue
        if last is None:
            last, running = carry.get(int(frame["part"].iloc[0]), (None, 0))
        keys = frame[key].to_numpy()
        v = frame[value].to_numpy(np.int64)
        upto = np.cumsum(v)
        new = np.r_[keys[0] != last, keys[1:] != keys[:-1]]
        base = np.r_[running, v[new] - upto[new]][np.cumsum(new)]
        before = base + upto - v
        last, running = keys[-1], int(before[-1] + v[-1])
        yield frame.assign(before=before)


def prefix_sums(df: DataFrame, key: str, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of the long ``value`` over the rows of the same ``key`` (a string or
    number without nulls) before it in ``order``, where rows equal in all of ``order`` follow in any order."""
    parts = ordered_parts(df, [key, *order])
    ends = parts.groupBy("part").agg(F.max(key).alias("last"))
    ends = parts.join(F.broadcast(ends), "part").where(F.col(key) == F.col("last"))
    ends = ends.groupBy("part").agg(F.first("last").alias("last"), F.sum(value).alias("sum")).orderBy("part").collect()
    first = {r["part"]: r["low"] for r in parts.groupBy("part").agg(F.min(key).alias("low")).collect()}
    carry, key_at, running = {}, None, 0
    for r in ends:  # a row for each range
        carry[r["part"]] = (key_at, running)
        running = (running if first[r["part"]] == r["last"] == key_at else 0) + r["sum"]
        key_at = r["last"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    out = parts.mapInPandas(lambda it: sums(it, key, value, carry), f"{fields}, before long")
    return out.withColumnRenamed("before", name).drop("part")


def size_class(size: Column) -> Column:
    """Sizes in ascending classes, sixteen to an octave and one for each below 32."""
    bits = F.length(F.bin(size))
    return bits * 32 + F.floor(size / F.pow(F.lit(2.0), F.greatest(bits - 5, F.lit(0)))).cast("int")


def draws(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """``sized`` (doc_id, source, size, and ``rows`` equal rows that this one stands for) with
    source_size, target and ``copies``, a row for each row.

    Within a source the order is: size class, then a hash of the id (null: of nothing),
    then the id and size. A null source is a source of its own; sources without words get no copies.
    """
    sizes = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    totals = keep(targets(sizes), "mix-targets")
    rows = sized.join(totals, sized["source"].eqNullSafe(totals["source"])).drop(totals["source"])
    each = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * ONE)).otherwise(0)
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    hashed = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "doc_id")), 1, 12), 16, 10).cast("long")
    rows = rows.withColumns(
        {
            "_name": name,
            "_each": each.cast("long") * F.col("rows"),
            "_class": size_class(F.col("size")),
            "_hash": hashed,
        }
    )
    rows = keep(prefix_sums(rows, "_name", ["_class", "_hash", "doc_id", "size"], "_each", "_before"), "mix-prefix-sums")
    upto = lambda x: F.shiftright(x, 24)

    def copies(offset: Column) -> Column:
        return upto(F.col("_before") + F.col("_each") + offset) - upto(F.col("_before") + offset)

    tried = rows.groupBy("_name").agg(
        F.first("target").alias("goal"),
        *[F.sum(copies(offset_of(seed, j)) * F.col("size")).alias(f"w{j}") for j in range(OFFSETS)],
    )
    misses = [F.struct(F.abs(F.col(f"w{j}") - F.col("goal")), F.lit(j).alias("j")) for j in range(OFFSETS)]
    best = keep(tried.select(F.col("_name").alias("_of"), F.least(*misses)["j"].alias("_j")), "mix-offsets")
    rows = rows.join(best, rows["_name"] == best["_of"])
    return rows.withColumn("copies", copies(offset_of(seed, F.col("_j")))).select(*sized.columns, "source_size", "target", "copies")


def offset_of(seed: int, j: Column | int) -> Column:
    """The ``j``-th random offset of the source ``_name``."""
    j = F.lit(j) if isinstance(j, int) else j
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), j, "_name")), 1, 6), 16, 10).cast("long")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row: doc_id, size (words; null text: 0), source_size, target of its source, words ``taken``, copies.

    Repeated rows are drawn like any others; an empty table gives an empty result. A null
    source is a source, the last. A text of any length is counted whole, row by row; equal
    sizes and ids are ordered by the row's contents. Further columns play no part.
    """
    sized = docs.select(
        col(doc_id).alias("doc_id"), col(source).alias("source"), words_of(col(text)).alias("size"), F.lit(1).alias("rows")
    )
    out = draws(keep(sized, "document-sizes"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return out.select("doc_id", "size", "source_size", "target", taken, "copies")


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, none where they are not.

    Rows equal in every column are drawn as one row with a count, whose expected copies
    are added. Texts are shuffled once, to meet their copies.
    """
    every = F.struct(*[col(c) for c in docs.columns])
    keys = ["doc_id", "source", "size", "print"]
    rows = docs.select(
        col(doc_id).alias("doc_id"),
        col(source).alias("source"),
        words_of(col(text)).alias("size"),
        F.sha2(F.to_json(every, {"ignoreNullFields": "false"}), 256).alias("print"),
        every.alias("rest"),
    )
    taken = draws(keep(rows.groupBy(*keys).agg(F.count("*").alias("rows")), "mix-rows")).where(F.col("copies") > 0)
    taken = keep(taken.select(F.col("print").alias("of"), "rows", "copies"), "mix-copies")
    texts = rows.select("print", "rest")
    once = texts.join(taken.where("rows = 1"), F.col("print") == F.col("of")).select("rest", "copies")
    # Of rows that are equal, one is repeated for all; combined before the shuffle.
    more = texts.join(taken.where("rows > 1"), F.col("print") == F.col("of"))
    more = more.groupBy("print", "copies").agg(F.first("rest").alias("rest")).select("rest", "copies")
    # A row repeated very often is unfolded in two steps, so that no array is long.
    step = 10_000
    out = once.union(more)
    out = out.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / step))))
    last = F.least(F.lit(step).cast("long"), F.col("copies") - F.col("block") * step)
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    return out.select(*[F.col("rest")[c].alias(c) for c in docs.columns])


#: The rows of ``mix`` over ``documents``.
SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [{", ".join(f"{w}.0::DOUBLE" for w in WEIGHTS)}][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % {len(WEIGHTS)} + 1] AS weight,
    source_size * {float(MOST)}::DOUBLE AS cap FROM s
), l AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w
), t AS (
  SELECT source, source_size,
    least(cap, coalesce(max(CASE WHEN cap >= level * weight THEN level END) OVER () * weight, cap)) AS target FROM l
), e AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, coalesce('s' || d.source, 'n') AS name,
    CASE WHEN t.source_size > 0 THEN round(t.target / t.source_size * {ONE})::BIGINT ELSE 0 END AS each,
    length(bin(d.size)) * 32 + (d.size >> greatest(length(bin(d.size)) - 5, 0)) AS class,
    ('0x' || substr(md5(concat_ws(':', {SEED}, d.doc_id)), 1, 12))::BIGINT AS hashed
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, (sum(each) OVER (PARTITION BY name ORDER BY class, hashed, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT AS upto FROM e
), o AS (
  SELECT name, j, ('0x' || substr(md5(concat_ws(':', {SEED}, j, name)), 1, 6))::BIGINT AS u
  FROM (SELECT DISTINCT name FROM e), range({OFFSETS}) r(j)
), c AS (
  SELECT p.name, j, u,
    abs(sum((((upto + u) // {ONE}) - ((upto - each + u) // {ONE})) * size) - any_value(target)) AS miss
  FROM p JOIN o ON p.name = o.name GROUP BY ALL
), b AS (
  SELECT name, u FROM c QUALIFY row_number() OVER (PARTITION BY name ORDER BY miss, j) = 1
)
SELECT doc_id, size, source_size, target, (((upto + u) // {ONE}) - ((upto - each + u) // {ONE}))::BIGINT * size AS taken,
  (((upto + u) // {ONE}) - ((upto - each + u) // {ONE}))::BIGINT AS copies
FROM p JOIN b ON p.name = b.name
"""
