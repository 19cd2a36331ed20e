"""Response actions for attack type and risk level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold import settings as cfg

_PLAYBOOK = "_type string, _level string, _special array<string>"
_DEFAULTS = "_level string, _usual array<string>"


def playbook_table(spark: SparkSession) -> DataFrame:
    """One row per attack type and level with its own actions."""
    rows = [(t, lv, acts) for t, levels in cfg.PLAYBOOKS.items() for lv, acts in levels.items()]
    return spark.createDataFrame(rows, "anomaly_type string, risk_level string, actions array<string>")


def default_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(cfg.DEFAULT_ACTIONS.items()), "risk_level string, actions array<string>")


def recommend(df: DataFrame, attack_col: str = "anomaly_type", level_col: str = "risk_level") -> DataFrame:
    """Add the array column ``actions``; both lookup tables are fixed and tiny."""
    spark = df.sparkSession
    special = F.broadcast(playbook_table(spark).toDF("_type", "_level", "_special"))
    usual = F.broadcast(default_table(spark).toDF("_dlevel", "_usual"))
    kind = F.coalesce(F.col(attack_col), F.lit("Normal"))
    level = F.coalesce(F.col(level_col), F.lit(""))
    none = F.array().cast("array<string>")
    quiet = F.array(*[F.lit(a) for a in cfg.DEFAULT_ACTIONS["Low"]])
    joined = df.join(special, (kind == F.col("_type")) & (level == F.col("_level")), "left").join(
        usual, level == F.col("_dlevel"), "left"
    )
    actions = (
        F.when(level == "", none)
        .when((level == "Low") | (kind == "Normal"), quiet)
        .otherwise(F.coalesce("_special", "_usual", none))
    )
    return joined.withColumn("actions", actions).select(*df.columns, "actions")


def work_list(recommended: DataFrame) -> DataFrame:
    """One row per event and action, in playbook order."""
    return recommended.select("event_id", F.posexplode("actions").alias("step", "action")).withColumn(
        "step", F.col("step") + 1
    )


def action_counts(recommended: DataFrame) -> DataFrame:
    return work_list(recommended).groupBy("action").agg(F.count(F.lit(1)).alias("n"))
