"""Profiles as they stood on the day of each transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_each(snapshots: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One profile for each customer and date; of several the largest by its columns."""
    return (
        snapshots.filter(F.col("snapshot_date").isNotNull() & F.col("cust_id").isNotNull())
        .groupBy(F.col("cust_id").cast("string").alias("_customer"), "snapshot_date")
        .agg(F.max(F.struct("snapshot_date", *columns)).alias("_profile"))
    )


def profiles_as_of(
    enriched: DataFrame, snapshots: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Add ``columns`` of the newest profile dated on or before the transaction's day.

    ``snapshots`` has ``cust_id``, ``snapshot_date`` and the columns, a row for each customer
    and date. ``snapshot_date`` of the profile used comes along; it and the columns are
    NULL before the first snapshot, and for rows without a customer or a time.

    Snapshots and the days on which a customer has transactions are put in one order, and
    the last profile is carried forward. Transactions are reduced to those days before
    the shuffle, so a customer with a third of all rows is a group of a few thousand days;
    the days go back to the transactions by a plain join, which adaptive execution splits.
    """
    day = F.to_date("transaction_date")
    rows = enriched.withColumn("_day", day)
    profile = _one_each(snapshots, columns)
    needed = (
        rows.filter(F.col("customer_id").isNotNull() & F.col("_day").isNotNull())
        .select(F.col("customer_id").alias("_customer"), "_day")
        .distinct()
        .withColumn("_profile", F.lit(None).cast(profile.schema["_profile"].dataType))
    )
    both = needed.unionByName(profile.withColumnRenamed("snapshot_date", "_day"))
    # A snapshot of the day itself comes first.
    in_order = (
        Window.partitionBy("_customer")
        .orderBy("_day", F.col("_profile").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    held = F.last("_profile", ignorenulls=True).over(in_order)
    valid = (
        both.select("_customer", "_day", F.col("_profile").isNull().alias("_asked"), held.alias("_held"))
        .filter("_asked")
        .select(F.col("_customer").alias("customer_id"), "_day", "_held")
    )

    def of(name: str) -> Column:
        return F.col(f"_held.{name}").alias(name)

    return rows.join(valid, ["customer_id", "_day"], "left").select(
        *enriched.columns, *map(of, columns), of("snapshot_date")
    )
