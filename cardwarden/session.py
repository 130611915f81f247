"""Session helpers for local runs, and the shared scratch location."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "cardwarden", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks.

    On a cluster the caller brings its own session; no operator sets
    configuration or looks up a master.
    """
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a working table that several jobs must share.

    It lies under the cluster's ``spark.checkpoint.dir`` so that every executor
    sees it. A machine-local folder is used only when that is unset and the whole
    application runs on one machine, as in tests; a cluster without the setting
    gets an error, since its executors could not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(
                "spark.checkpoint.dir must name a folder that the driver and all executors share"
            )
        base = tempfile.mkdtemp(prefix="cardwarden-")
    return f"{base.rstrip('/')}/cardwarden-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read again.

    Later jobs start from the files, so a lost executor costs a read and not the
    work before it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete the files of a table from ``stored`` that nothing will read again."""
    spark = table.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._stored_at).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_cardwarden_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='cardwarden-')}/cardwarden", "zip", root, "cardwarden"
    )
    context.addPyFile(archive)
    context._cardwarden_shipped = True
