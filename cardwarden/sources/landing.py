"""Bronze landing: raw rows kept as delivered, replaceable file by file."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.sources.readers import read_profiles, read_transactions_by_header
from cardwarden.sources.sinks import replace_files


# Spark writes a URI without authority with one slash or three. A letter stands in
# front, so that no key can be read as a number.
_SLASHES = r"^([A-Za-z][\w+.-]*):/+"


def _file_key(uri: str) -> Column:
    path = F.regexp_replace(uri, _SLASHES, "$1:/")
    return F.concat(F.lit("f"), F.md5(path)).alias("source_file")


def file_keys(uris: Iterable[str]) -> list[str]:
    """The keys of files, as the rows of theirs carry them in source_file."""
    paths = (re.sub(_SLASHES, r"\1:/", uri, flags=re.ASCII) for uri in uris)
    return sorted({"f" + hashlib.md5(p.encode()).hexdigest() for p in paths})


def _land(raw: DataFrame, files: list[str], path: str, ingested_at: datetime | None) -> list[str]:
    # One partition per delivered file, named by its whole path: delivering a file
    # again replaces its rows and no others, and equal names in two folders are two
    # files. Scan tasks write their own split, without a shuffle.
    stamp: Column = F.lit(ingested_at) if ingested_at else F.current_timestamp()
    landed = raw.select(
        "*", stamp.cast("timestamp").alias("ingested_at"), _file_key("source_path")
    )
    replace_files(raw.sparkSession, landed, path, files, uuid.uuid4().hex)
    return files


def land_transactions(
    spark: SparkSession,
    source: str,
    bronze: str,
    ingested_at: datetime | None = None,
    required: Iterable[str] = (),
) -> list[str]:
    """Land raw transaction CSV files as all-text parquet; return the files' keys.

    The files may have different headers. With ``required`` a file without one of
    these columns is an error, before anything is landed.
    """
    raw, uris = read_transactions_by_header(spark, source, list(required))
    return _land(raw, file_keys(uris), bronze, ingested_at)


def land_profiles(
    spark: SparkSession,
    source: str,
    bronze: str,
    ingested_at: datetime | None = None,
    multi_line: bool = True,
) -> list[str]:
    """Land customer profile JSON files; return the files' keys."""
    raw = read_profiles(spark, source, multi_line)
    files = file_keys(raw.inputFiles())
    raw = raw.select("*", F.col("_metadata.file_path").alias("source_path"))
    return _land(raw, files, bronze, ingested_at)
