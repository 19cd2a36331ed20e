"""A training corpus from raw documents: five stages, each written as Parquet and read again.

1. language: documents in no language go (no letter, or words that fit no language).
2. near_copies: one document of each group of near copies (five-word shingles, Jaccard 0.8) stays;
   candidates come from SimHash and BK-trees, and from MinHash.
3. secrets: spans of secrets are replaced by a mark; no document goes.
4. mix: rows are taken as often as the mix of sources takes them.
5. tokens: byte-level BPE ids of each text, and what they decode to.

A stage works on whatever its predecessor kept. Nulls in any column, empty tables,
repeated rows and further columns are as described at each operator; the stages 1 to 4
return the columns they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.llm import bpe, copies, language, mixing, secrets
from watchfold.llm.common import prepare, table
from watchfold.session import keep

LEAST_SCORE = 0.3  # mean probability of the best language below which a document is in none


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language.known_language(docs, LEAST_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return copies.drop_similar(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without secrets; ``n_chars`` counts what is left."""
    prepare(spark)
    return secrets.hide_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed_rows(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: doc_id, lang, source, the token ids, their number and the digest of the decoded bytes."""
    prepare(spark)
    rows = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text")).drop("text"))
    return rows.select(
        "doc_id",
        "lang",
        "source",
        "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("text_sha256"),
    )


STAGES = [
    ("language", keep_known_languages),
    ("near_copies", drop_near_copies),
    ("secrets", hide_secrets),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: The language model and the near copies are not SQL; a plain version is in the tests.
ORACLE_SQL = None
