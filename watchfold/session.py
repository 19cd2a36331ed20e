"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "watchfold") -> SparkSession:
    """Session for tests and the benchmark; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where a local session names none (tests) a temporary folder is created and
    remembered in the session; on a cluster that is an error, because machines would
    write to folders of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        named = tempfile.mkdtemp(prefix="watchfold-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors and gives later stages
    column pruning and size statistics.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per session).

    A cluster job that passes the package with ``--py-files`` does not need it.
    """
    if spark.conf.get("watchfold.shipped", None):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="watchfold-code-"))
    archive = shutil.make_archive(str(target / "watchfold"), "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("watchfold.shipped", "true")
