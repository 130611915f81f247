"""Bronze to Silver: renaming, typing, null handling, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.functions import (
    parse_amount,
    parse_timestamp,
    sentinel_to_null,
    source_or_null,
)


def _refined_columns(
    bronze: DataFrame, ingested_at: datetime | None, timestamp_format: str | None
) -> list[Column]:
    stamp = F.lit(ingested_at) if ingested_at else F.current_timestamp()
    return [
        F.col("tx_id").alias("transaction_id"),
        F.col("cust_id").alias("customer_id"),
        parse_amount(F.col("tx_amount")).alias("amount"),
        parse_timestamp(F.col("tx_datetime"), timestamp_format).alias("transaction_date"),
        F.col("tx_category").alias("category"),
        source_or_null(bronze, "latitude"),
        source_or_null(bronze, "longitude"),
        stamp.cast("timestamp").alias("ingested_at"),
    ]


def refine(
    bronze: DataFrame,
    ingested_at: datetime | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Raw text rows to the eight typed Silver columns; rows without id are dropped."""
    return bronze.filter(F.col("tx_id").isNotNull()).select(
        *_refined_columns(bronze, ingested_at, timestamp_format)
    )


def refine_enriched(
    bronze: DataFrame,
    ingested_at: datetime | None = None,
    timestamp_format: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Silver plus channel, city, IP, device and ``keep``, with sentinels set to NULL."""
    return bronze.filter(F.col("tx_id").isNotNull()).select(
        *_refined_columns(bronze, ingested_at, timestamp_format),
        F.col("channel"),
        sentinel_to_null(F.col("location_city")).alias("location_city"),
        sentinel_to_null(F.col("ip_address")).alias("ip_address"),
        sentinel_to_null(F.col("device_id")).alias("device_id"),
        *keep,
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    ``row_number() = 1`` lets Catalyst place a group limit below the shuffle, so
    a key with any number of copies sends at most one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
