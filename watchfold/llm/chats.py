"""Chats for training: collapse logged snapshots of one conversation, then render.

A log often holds a conversation again after each turn. A rolling hash of the turns so
far marks every prefix of every conversation; a conversation whose whole hash is that of
a shorter prefix of another one is a snapshot of it, and an anti-join drops it. Of equal
conversations the one with the smallest id stays.

The rolling hash of a prefix is the sum of hashes of (place, role, text), in two
independent sums of 64 bits, so prefixes of one conversation are sums along its turns. A
conversation may hold most turns, so turns are ordered in ranges that hand their sums on,
and texts are put together in blocks of ``BLOCK`` turns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.llm.common import col, ordered_parts, partitions
from watchfold.session import keep

BLOCK = 1000  # turns put together at first


def run_sums(frames: Iterator[pd.DataFrame], carry: dict) -> Iterator[pd.DataFrame]:
    """Ordered turns with ``place`` and the sums ``h1`` and ``h2`` up to and with each turn."""
    last, sums = None, np.zeros(3, np.uint64)
    started = False
    for frame in frames:
        if not len(frame):
            continue
        if not started:
            last, sums = carry.get(int(frame["part"].iloc[0]), (None, sums))
            started = True
        keys = frame["conv"].to_numpy()
        new = np.r_[keys[0] != last, keys[1:] != keys[:-1]]
        group = np.cumsum(new)
        at = np.arange(len(keys))
        first = np.maximum.accumulate(np.where(new, at, 0))
        place = (at - first + 1).astype(np.uint64) + np.where(group == 0, sums[0], np.uint64(0))
        out = [place]
        for k, name in ((1, "r1"), (2, "r2")):
            mixed = frame[name].to_numpy(np.int64).view(np.uint64) ^ (place * np.uint64(0x9E3779B97F4A7C15))
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(27)
            upto = np.cumsum(mixed)
            base = np.r_[sums[k], mixed[new] - upto[new]][group]
            out.append(base + upto)
        last, sums = keys[-1], np.array([o[-1] for o in out], np.uint64)
        yield pd.DataFrame({"conv": keys, "place": out[0].view(np.int64), "h1": out[1].view(np.int64), "h2": out[2].view(np.int64), "turn_row": frame["turn_row"]})


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv, turn, role, text) with place from 1 and the hashes of the prefix up to there."""
    said = [F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("role", "text")]
    rows = turns.select(
        "conv",
        "turn",
        F.xxhash64(*said).alias("r1"),
        F.xxhash64(F.lit(1), *said).alias("r2"),
        F.struct("role", "text").alias("turn_row"),
    )
    parts = ordered_parts(rows, ["conv", "turn", "r1", "r2"])
    light = parts.select("part", "conv", "r1", "r2")
    # What a range hands on: its last conversation's turns, summed as if they stood alone; places need the count first.
    ends = light.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    tail = light.join(F.broadcast(ends.select("part", "high")), "part").where(F.col("conv") == F.col("high"))
    count = {r["part"]: r["count"] for r in tail.groupBy("part").count().collect()}
    ends = ends.orderBy("part").collect()  # a row for each range
    carry, key, place = {}, None, 0
    for r in ends:
        carry[r["part"]] = (key, np.array([place, 0, 0], np.uint64))
        place = (place if r["low"] == r["high"] == key else 0) + count[r["part"]]
        key = r["high"]
    kinds = {f.name: f.dataType.simpleString() for f in parts.schema.fields}
    schema = f"conv {kinds['conv']}, place long, h1 long, h2 long, turn_row {kinds['turn_row']}"
    # First with the places only, to learn each range's own sums; then with the sums handed on.
    bare = parts.withColumn("turn_row", F.lit(None).cast(kinds["turn_row"]))
    own = bare.mapInPandas(lambda it: tails(run_sums(it, carry)), f"conv {kinds['conv']}, h1 long, h2 long, part long")
    own = {r["part"]: r for r in own.collect()}
    key, sums = None, np.zeros(2, np.uint64)
    with np.errstate(over="ignore"):
        for r in ends:
            before = carry[r["part"]][1].copy()
            before[1:] = sums
            carry[r["part"]] = (key, before)
            mine = np.array([own[r["part"]]["h1"], own[r["part"]]["h2"]], np.int64).view(np.uint64)
            sums = mine + (sums if r["low"] == r["high"] == key else np.uint64(0))
            key = r["high"]
    return parts.mapInPandas(lambda it: run_sums(it, carry), schema)


def tails(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last row of a range: the sums over its last conversation, as far as it lies there."""
    from pyspark import TaskContext

    last = None
    for frame in frames:
        last = frame.iloc[-1:]
    if last is not None:
        yield last[["conv", "h1", "h2"]].assign(part=TaskContext.get().partitionId())


def rendered(role: Column, text: Column) -> Column:
    """One turn in the chat format; a missing role is ``user``, a missing text empty."""
    return F.concat(
        F.lit("<|im_start|>"), F.coalesce(role, F.lit("user")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n")
    )


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per maximal conversation: conv_id, n_turns and the rendered ``chat``.

    Turns stand in the order of ``turn`` (null first), equal ones in a fixed order of
    their contents; repeated rows are repeated turns. A null conv_id is a conversation of
    its own; null roles and texts differ from empty ones. An empty table gives an empty result.
    """
    rows = turns.select(col(conv_id).alias("conv"), col(turn).alias("turn"), col(role).alias("role"), col(text).alias("text"))
    # A null id, as a flag and a value, so that it groups like any other.
    kind = dict(rows.dtypes)["conv"]
    rows = rows.withColumn("conv", F.struct(F.col("conv").isNotNull().alias("known"), F.col("conv").alias("id")))
    rows = rows.withColumn("conv", F.when(F.col("conv.known"), F.concat(F.lit("="), F.col("conv.id").cast("string"))).otherwise(""))
    said = keep(prefixes(rows), "turn-prefixes")
    ids = said.select("conv", "place", "h1", "h2")
    sizes = ids.groupBy("conv").agg(F.max("place").alias("n_turns"))
    last = ids.join(sizes, (ids["conv"] == sizes["conv"]) & (ids["place"] == sizes["n_turns"])).drop(sizes["conv"])
    number = F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30).cast(kind))
    one = last.groupBy("n_turns", "h1", "h2").agg(
        F.min(F.struct(number.isNull().alias("last"), number.alias("id"), F.col("conv").alias("conv")))["conv"].alias("conv")
    )
    one = keep(one, "distinct-conversations")
    # Prefixes shorter than their conversation, each once.
    shorter = ids.join(sizes, "conv").where(F.col("place") < F.col("n_turns"))
    shorter = shorter.select(F.col("place").alias("n_turns"), "h1", "h2").distinct()
    whole = keep(one.join(shorter, ["n_turns", "h1", "h2"], "left_anti").select("conv", "n_turns"), "maximal-conversations")
    texts = said.join(whole, "conv").withColumn("block", F.floor((F.col("place") - 1) / BLOCK))
    # By block too, so that a long conversation is put together in many tasks.
    texts = texts.repartition(partitions(turns.sparkSession), "conv", "block")
    line = F.struct("place", rendered(F.col("turn_row.role"), F.col("turn_row.text")).alias("line"))
    joined = lambda rows: F.array_join(F.transform(F.array_sort(rows), lambda x: x["line"]), "")
    blocks = texts.groupBy("conv", "n_turns", "block").agg(joined(F.collect_list(line)).alias("line"))
    chats = blocks.groupBy("conv", "n_turns").agg(
        joined(F.collect_list(F.struct(F.col("block").alias("place"), "line"))).alias("chat")
    )
    return chats.select(number.alias("conv_id"), "n_turns", "chat")


#: The rows of ``format_chats`` over ``conversations``.
SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place, role, text FROM conversations
), c AS (
  SELECT conv_id, count(*) AS n_turns,
    list(coalesce('=' || role, '') || chr(0) || coalesce('=' || text, '') ORDER BY place) AS turns,
    string_agg('<|im_start|>' || coalesce(role, 'user') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY place) AS chat
  FROM t GROUP BY conv_id
), u AS (
  SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY turns ORDER BY conv_id) = 1
), p AS (
  SELECT DISTINCT k AS n_turns, turns[1:k] AS turns FROM c, unnest(range(1, c.n_turns)) r(k)
)
SELECT conv_id, n_turns, chat FROM u WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n_turns = u.n_turns AND p.turns = u.turns)
"""
