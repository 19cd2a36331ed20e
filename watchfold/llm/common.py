"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.session import keep, shared_folder, ship_code

#: A word, for every operator: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of whole texts, and bytes of any rows, that a Python worker is sent at once.
TEXTS_AT_ONCE = 1000
BYTES_AT_ONCE = 64 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the code to the workers, and send them whole texts in small Arrow batches."""
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_AT_ONCE)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_AT_ONCE)


def own_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder: partitions stay as they are, lineage is cut."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def ordered_parts(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` in the total order of ``order``, in range partitions numbered by the column ``part``.

    A group of any size spreads over many partitions. The partitions are stored, so
    that a first pass can gather one row per partition (what it hands to the next
    one) and a second pass sees the very same partitions.
    """
    cols = [col(c) for c in order]
    placed = df.repartitionByRange(partitions(df.sparkSession), *cols).sortWithinPartitions(*cols)
    return checkpointed(placed.withColumn("part", F.spark_partition_id()))


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        if np.array_equal(before, label):
            return label


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b: of one orderable type, no nulls) as (node, root).

    ``root`` is the smallest node reachable; nodes without a link to another have no
    row. Alternates large and small stars: in each half round, every node passes the
    smallest neighbour it knows to its other neighbours, so the link table never grows
    and no neighbour list is gathered. Each round's links are a stored table.
    """
    pair = keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = state(pair)
    while seen[0]:
        # Large stars: larger neighbours of a node point to the smallest node around it.
        both = pair.select("a", "b").union(pair.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        big = pair.join(low, pair["b"] == low["k"]).select(F.col("a"), F.col("m").alias("b"))
        big = keep(big.where("a <> b").distinct(), "large-stars")
        # Small stars: smaller neighbours of a node, and itself, point to the smallest of them.
        low = big.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        small = big.join(low, big["a"] == low["k"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select(F.col("k").alias("a"), F.col("m").alias("b")))
        pair = keep(small.where("a <> b").distinct(), "small-stars")
        now = state(pair)
        if now == seen:
            break
        seen = now
    nodes = pair.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(pair.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def attach(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (a stored table) with the columns of ``groups``, which has at most one row per key; nulls are keys too.

    A key with more than one partition's share of all rows would land in one task, so
    those keys, which are no more than there are partitions, are broadcast; the rest
    is shuffled.
    """
    spark = rows.sparkSession
    extra = [c for c in groups.columns if c not in keys]
    many = F.col("count") * F.lit(partitions(spark)) > F.lit(rows.count())
    hot = keep(rows.groupBy(*keys).count().where(many).select(*keys), "hot-keys")

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(*[F.col(c).alias(f"_key_{c}") for c in keys], *[c for c in right.columns if c not in keys])
        same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys]
        on = same[0]
        for s in same[1:]:
            on = on & s
        out = left.join(right, on, how)
        return out if how == "left_anti" else out.drop(*[f"_key_{c}" for c in keys])

    known = joined(groups, F.broadcast(hot), "inner").select(*keys, *extra)
    often = joined(joined(rows, F.broadcast(hot), "inner"), F.broadcast(known), "left")
    rare = joined(joined(rows, F.broadcast(hot), "left_anti"), groups, "left")
    return often.unionByName(rare)


def whole_groups(batches: Iterable, keys: list[str], rows: int) -> Iterator:
    """Pandas frames of a sorted partition, joined and cut between groups at about ``rows`` rows."""
    import pandas as pd

    held: list = []
    n = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        n += len(batch)
        if n < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        last = frame[keys].iloc[-1]
        same = (frame[keys] == last).all(axis=1).to_numpy()
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield frame.iloc[:cut].reset_index(drop=True)
        held, n = [frame.iloc[cut:].reset_index(drop=True)], len(frame) - cut
    if n:
        yield pd.concat(held, ignore_index=True)
