"""Registered queries of the training-data operators, with their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.llm import bpe, centroids, chats, codes, embeddings, language, licenses, mixing, pages, passages, quality, secrets, simhash
from watchfold.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_mix_sources", mixing.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's tokens and of what they decode to."""
    return bpe.digests(table(spark, sf_dir, "documents"))


@query("op3_embedding_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


@query("op5_chat_format", chats.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return chats.format_chats(table(spark, sf_dir, "conversations"))


@query("op6_secret_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op8_repeated_passages")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that documents share."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query("op10_html_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.extract(table(spark, sf_dir, "pages"))


@query("op11_vector_codes", codes.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    return codes.compressed(table(spark, sf_dir, "embeddings"))


@query("op12_license_scan", licenses.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that every document names or quotes."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op13_centroid_clusters", centroids.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector."""
    return centroids.clustered(table(spark, sf_dir, "embeddings"))
