"""Views of the given test tables in the shapes the operators expect.

``events`` plays the transactions: the small integer ``k`` in its properties
stands for the device, the IP address and a grid position. Every view keeps all
rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k():
    # The properties hold this one number; matching it is cheaper than parsing JSON.
    return F.regexp_extract("props", r'"k":\s*(\d+)', 1).cast("int")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as enriched Silver rows, including positions."""
    k, kind = F.col("k"), F.col("event_type")
    placed = k % 17 != 0
    channel = (
        F.when(kind == "purchase", "Físico")
        .when(kind.isin("click", "view"), "App")
        .otherwise("Online")
    )
    in_store = kind == "purchase"
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", _k())
        .select(
            F.col("event_id").cast("string").alias("transaction_id"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.col("value").alias("amount"),
            F.col("ts").alias("transaction_date"),
            kind.alias("category"),
            F.when(placed, (k % 10) * 10 - 45.0).cast("double").alias("latitude"),
            F.when(placed, F.floor(k / 10) * 20 - 90.0).cast("double").alias("longitude"),
            channel.alias("channel"),
            F.when(in_store, F.concat(F.lit("C"), k % 20)).alias("location_city"),
            F.when(~in_store, F.concat(F.lit("10.0.0."), k)).alias("ip_address"),
            k.cast("string").alias("device_id"),
        )
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw text rows, some of them bad.

    Odd ``k`` write the amount with a decimal comma; a few ``k`` have no id, an
    amount that is no number, or a date in another format.
    """
    k = F.col("k")
    text = F.col("value").cast("string")
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", _k())
        .withColumn("in_store", F.col("event_type") == "purchase")
        .select(
            F.when(k != 13, F.col("event_id").cast("string")).alias("tx_id"),
            F.col("user_id").cast("string").alias("cust_id"),
            F.when(k == 9, F.date_format("ts", "dd/MM/yyyy"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .alias("tx_datetime"),
            F.when(k == 7, "abc")
            .when(k == 8, F.concat(F.lit("1."), F.translate(text, ".", ",")))
            .when(k % 2 == 1, F.translate(text, ".", ","))
            .otherwise(text)
            .alias("tx_amount"),
            F.col("event_type").alias("tx_category"),
            F.when(F.col("in_store"), "Físico")
            .when(F.col("event_type").isin("click", "view"), "App")
            .otherwise("Online")
            .alias("channel"),
            F.when(F.col("in_store"), F.concat(F.lit("C"), k % 20))
            .otherwise("N/A")
            .alias("location_city"),
            F.when(F.col("in_store"), "N/A")
            .otherwise(F.concat(F.lit("10.0.0."), k))
            .alias("ip_address"),
            k.cast("string").alias("device_id"),
        )
    )


def bronze_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as clean raw text rows that carry coordinates."""
    rows = transactions(spark, sf_dir)
    return rows.select(
        F.col("transaction_id").alias("tx_id"),
        F.col("customer_id").alias("cust_id"),
        F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss").alias("tx_datetime"),
        F.col("amount").cast("string").alias("tx_amount"),
        F.col("category").alias("tx_category"),
        "channel",
        F.coalesce("location_city", F.lit("N/A")).alias("location_city"),
        F.coalesce("ip_address", F.lit("N/A")).alias("ip_address"),
        "device_id",
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile per customer, under the customer's number and 15.

    The shift leaves the first customers without profile and adds profiles without
    transactions. Trusted devices are the customer's own ``k`` below 50, and products the kinds
    of their events, or else their market segment. Both are sets over small
    domains, so they stay small for any customer.
    """
    k = F.col("k")
    used = (
        table(spark, sf_dir, "events")
        .withColumn("k", _k())
        .groupBy(F.col("user_id").alias("c_custkey"))
        .agg(
            F.sort_array(F.collect_set("event_type")).alias("kinds"),
            F.sort_array(F.collect_set(F.when(k < 50, k.cast("string")))).alias("devices"),
        )
    )
    balance = F.col("c_acctbal")
    return (
        table(spark, sf_dir, "customer")
        .join(used, "c_custkey", "left")
        .select(
            (F.col("c_custkey") + 15).alias("cust_id"),
            F.col("c_name").alias("name"),
            F.when(balance < 2500, "Bronze")
            .when(balance < 5000, "Silver")
            .when(balance < 7500, "Gold")
            .otherwise("Platinum")
            .alias("loyalty_tier"),
            F.concat(F.lit("C"), "c_nationkey").alias("home_city"),
            F.coalesce("kinds", F.array("c_mktsegment")).alias("active_products"),
            F.coalesce("devices", F.array().cast("array<string>")).alias("known_devices"),
        )
    )


def profile_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated profile for each customer and week of ``events``, on the Monday after it.

    Trusted devices are the customer's ``k`` of that week, the tier follows their number.
    """
    rows = table(spark, sf_dir, "events").withColumn("k", _k())
    devices = F.sort_array(F.collect_set(F.col("k").cast("string")))
    return (
        rows.groupBy(
            F.col("user_id").alias("cust_id"),
            F.date_add(F.trunc("ts", "week"), 7).alias("snapshot_date"),
        )
        .agg(devices.alias("known_devices"))
        .withColumn("loyalty_tier", F.when(F.size("known_devices") > 1, "Gold").otherwise("Silver"))
    )


def with_repeats(rows: DataFrame) -> DataFrame:
    """Transactions plus a second, later copy of every one of kind ``error``."""
    first = rows.withColumn("version", F.lit(1))
    again = rows.filter(F.col("category") == "error").select(
        *[c for c in rows.columns if c != "amount"],
        (F.col("amount") + 1).alias("amount"),
        F.lit(2).alias("version"),
    )
    return first.unionByName(again)


def rule_matrix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with the columns the documented rule matrix names."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "processed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("void")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.when(F.col("o_custkey") % 97 != 0, F.col("o_custkey").cast("string")).alias(
            "customer_id"
        ),
        (F.floor("o_totalprice") - 20000).alias("points_earned"),
        status.alias("status"),
        F.col("o_orderdate").alias("transaction_date"),
    )
