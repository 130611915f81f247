"""Parquet sinks. All of them can be run again without doubling any row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_flat(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``; keep all others."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_daily(df: DataFrame, path: str, day: str = "dt_particao") -> int:
    """Replace the days present in ``df``; return the number of rows written.

    Rebalancing gathers each day's rows to avoid a small file per task and day,
    and, unlike a plain repartition by day, lets adaptive execution split a day
    that is far larger than the others. The rows are counted by the write itself,
    above the rebalancing so that an empty result is counted too.
    """
    counted = Observation()
    balanced = df.hint("rebalance", day).observe(counted, F.count(F.lit(1)).alias("n"))
    write_partitions(balanced, path, [day])
    return counted.get["n"]


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if nothing has been written to it yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _partition(path: str, by: str, value: object) -> str:
    name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
    return f"{path.rstrip('/')}/{by}={name}"


def _file_system(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_partitions(spark: SparkSession, path: str, by: str, values: Iterable) -> None:
    """Delete whole partitions, on any file system that Spark can reach."""
    for value in values:
        folder, system = _file_system(spark, _partition(path, by, value))
        system.delete(folder, True)


def drop_table(spark: SparkSession, path: str) -> None:
    folder, system = _file_system(spark, path)
    system.delete(folder, True)


def read_partitions(
    spark: SparkSession, path: str, by: str, values: Iterable, kind: str = "string"
) -> DataFrame | None:
    """The rows of some partitions, or None if there is none of them.

    Only these partitions are listed and read, whatever else the table holds; their
    columns are those of all their files.
    """
    found = []
    for value in values:
        folder, system = _file_system(spark, _partition(path, by, value))
        if system.exists(folder):
            found.append(folder.toString())
    if not found:
        return None
    reader = spark.read.option("basePath", path).option("mergeSchema", True)
    try:
        return reader.parquet(*found).withColumn(by, F.col(by).cast(kind))
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def days_of(rows: DataFrame | None, day: str) -> set[date | None]:
    """The distinct days of a table, one value each."""
    return set() if rows is None else {r[0] for r in rows.select(day).distinct().collect()}


def partition_days(spark: SparkSession, path: str, day: str) -> set[date | None]:
    """The days that a table has partitions of, from its folders' names alone."""
    folder, system = _file_system(spark, path)
    if not system.exists(folder):
        return set()
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    values = [n.removeprefix(f"{day}=") for n in names if n.startswith(f"{day}=")]
    return {None if v.startswith("__HIVE") else date.fromisoformat(v) for v in values}


def replace_days(df: DataFrame, path: str, day: str, covered: Iterable[date | None]) -> None:
    """Replace the covered days, and empty those that ``df`` has no rows of.

    ``df`` must be a stored table: its days are listed after it is written.
    """
    write_partitions(df.hint("rebalance", day), path, [day])
    drop_partitions(df.sparkSession, path, day, set(covered) - days_of(df, day))


def replace_files(
    spark: SparkSession, df: DataFrame | None, path: str, files: Iterable[str], delivery: str
) -> None:
    """Replace what the table has of the delivered source files, the emptied ones too.

    Nothing is read but what has been written.
    """
    gone = set(files)
    if df is not None:
        write_partitions(df.withColumn("delivery", F.lit(delivery)), path, ["source_file"])
        now = read_partitions(spark, path, "source_file", gone)
        if now is not None:
            gone -= days_of(now.filter(F.col("delivery") == delivery), "source_file")
    drop_partitions(spark, path, "source_file", gone)
