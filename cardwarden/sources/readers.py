"""Scans. Nothing here starts more than a header read."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import schemas


def read_transactions_csv(spark: SparkSession, path: str | Sequence[str], infer: bool = False) -> DataFrame:
    """Raw transaction files: header row, one column per header name.

    Columns are text. Names come from the first file's header, so columns may
    stand in any order and optional ones (coordinates) appear when present; a
    file whose header differs from it is an error rather than a silent shift of
    columns. Lines with too few or too many fields keep their text in
    ``_corrupt_record``. ``infer`` costs one more pass over the data.
    """
    with_header = spark.read.option("header", True)
    if infer:
        return with_header.option("inferSchema", True).csv(path)
    names = with_header.csv(path).columns
    text = T.StructType(
        [T.StructField(name, T.StringType(), True) for name in [*names, schemas.CORRUPT_RECORD]]
    )
    return (
        with_header.schema(text)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT_RECORD)
        .csv(path)
    )


def _first_lines(spark: SparkSession, uris: Sequence[str]) -> dict[str | None, list[str]]:
    """The files' paths by their first line, which is all that is read of them."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    codecs = hadoop.io.compress.CompressionCodecFactory(configuration)
    found: dict[str | None, list[str]] = {}
    for uri in uris:
        path = hadoop.fs.Path(jvm.java.net.URI(uri))
        stream = path.getFileSystem(configuration).open(path)
        try:
            codec = codecs.getCodec(path)
            text = stream if codec is None else codec.createInputStream(stream)
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
        finally:
            stream.close()
        plain = re.sub(r"([\\\[\]{}*?])", r"\\\1", path.toString())
        found.setdefault(line or None, []).append(plain)
    return found


def read_transactions_by_header(
    spark: SparkSession, path: str, required: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Raw transaction files whose headers may differ, and the files' URIs.

    Files with one header are one scan, and the scans are united by column name: a
    column that a file does not have is NULL in its rows. ``source_path`` names each
    row's file. Empty files have no rows. The driver reads every file's first line and
    nothing more; a file without one of the ``required`` columns is an error.
    """
    uris = list(spark.read.text(path).inputFiles())
    groups = _first_lines(spark, uris)
    groups.pop(None, None)
    whole = None
    for files in groups.values():
        rows = read_transactions_csv(spark, path if len(files) == len(uris) else files)
        missing = [c for c in required if c not in rows.columns]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
        rows = rows.select("*", F.col("_metadata.file_path").alias("source_path"))
        whole = rows if whole is None else whole.unionByName(rows, allowMissingColumns=True)
    if whole is None:
        names = [*schemas.BRONZE.fieldNames(), schemas.CORRUPT_RECORD, "source_path"]
        fields = [T.StructField(name, T.StringType(), True) for name in names]
        whole = spark.createDataFrame([], T.StructType(fields))
    return whole, uris


def read_profiles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Customer profiles, by default files that each hold one JSON array.

    An array file cannot be split, so parallelism is one task per file. Deliver
    large snapshots as many files, or as JSON lines with ``multi_line=False``. A file
    of JSON lines read as an array would lose all rows but its first, so it is an error.
    """
    if multi_line:
        files = spark.read.text(path, wholetext=True)
        if files.filter(F.col("value").rlike(r"(?s)^\s*\{.*\}\s*\n\s*\{")).head(1):
            raise ValueError(f"{path} holds JSON lines; read it with multi_line=False")
    return spark.read.schema(schemas.PROFILE).option("multiLine", multi_line).json(path)


def read_table(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """A parquet table; with ``merge`` it has the columns of all its files."""
    return spark.read.option("mergeSchema", merge).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table, or an empty one of that schema if it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order, as a distributed top-n."""
    return df.orderBy(*order_by).limit(n)


def path_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register a temporary view over a parquet path and return it."""
    quoted = path.replace("\\", "\\\\").replace('"', '\\"')
    spark.sql(
        f'CREATE OR REPLACE TEMPORARY VIEW `{name}` USING parquet OPTIONS (path "{quoted}")'
    )
    return spark.table(name)
