"""Scans and sinks: files with explicit schemas, fitted state as plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold.sources.access_log import access_schema


def read_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan raw access events; the schema is declared, never inferred."""
    reader = spark.read.schema(access_schema())
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
    return reader.format(fmt).load(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Write a result table; CSV keeps a header so that it can be read back."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def clustered(df: DataFrame) -> DataFrame:
    """Lay events out by entity and time, in evenly sized parts.

    The parts are ranges over (entity, time, id) found by sampling, so a hot entity
    spreads over many of them; look-ups of an entity skip the other files.  Their
    number is left to adaptive execution.
    """
    keys = ["entity_id", "event_ts", "event_id"]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_events_by_day(df: DataFrame, path: str) -> str:
    """Enriched or scored events, one folder per day so that date filters prune."""
    dated = df.withColumn("event_date", F.to_date("event_ts"))
    return write_table(dated, path, partition_by=["event_date"])


def write_report_lines(lines: DataFrame, path: str) -> str:
    """Report text, one row per line, already in its final order."""
    lines.select("line").write.mode("overwrite").text(path)
    return path


def split_matrix(matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Processed table -> (targets, features), both keyed by ``event_id``."""
    targets = ["event_id", "label", "anomaly_type"]
    features = [c for c in matrix.columns if c not in ("label", "anomaly_type", "entity_id")]
    return matrix.select(*targets), matrix.select(*features)


def with_event_id(df: DataFrame) -> DataFrame:
    """Live records may come without an id; give those a random one."""
    made = F.concat(F.lit("rt_"), F.expr("uuid()"))
    if "event_id" not in df.columns:
        return df.withColumn("event_id", made)
    return df.withColumn("event_id", F.coalesce(F.col("event_id").cast("string"), made))
