"""Gold tables and the queries the dashboards ask of them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def category_kpis(
    silver: DataFrame, as_of: date | None = None, exact_scale: int | None = None
) -> DataFrame:
    """Revenue and number of transactions per category, largest revenue first.

    Doubles lose cents once sums pass about 10^13. ``exact_scale`` sums decimals
    with that many places instead; the result keeps its double type.
    """
    amount = F.col("amount")
    if exact_scale is not None:
        amount = amount.try_cast(f"decimal(28,{exact_scale})")
    return (
        silver.groupBy("category")
        .agg(
            F.round(F.sum(amount), 2).cast("double").alias("total_revenue"),
            F.count("transaction_id").alias("transaction_volume"),
        )
        .withColumn("calculation_date", F.lit(as_of) if as_of else F.current_date())
        .orderBy(F.desc("total_revenue"), "category")
    )


#: Digits and places of the sums that are kept by day.
_SUM = "decimal(28,6)"


def daily_category_sums(silver: DataFrame, day: str) -> DataFrame:
    """Revenue and number of transactions by day and category, to be summed further."""
    return silver.groupBy(day, "category").agg(
        F.sum(F.col("amount").try_cast(_SUM)).alias("revenue"),
        F.count("transaction_id").alias("transactions"),
    )


def kpis_from_sums(sums: DataFrame, as_of: date | None = None) -> DataFrame:
    """The KPIs of ``category_kpis``, from sums over any days."""
    return (
        sums.groupBy("category")
        .agg(
            F.round(F.sum("revenue"), 2).cast("double").alias("total_revenue"),
            F.sum("transactions").alias("transaction_volume"),
        )
        .withColumn("calculation_date", F.lit(as_of) if as_of else F.current_date())
        .orderBy(F.desc("total_revenue"), "category")
    )


def kpis_for_categories(kpis: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """The KPI rows of the chosen categories; all of them by default."""
    return kpis if categories is None else kpis.filter(F.col("category").isin(*categories))


def kpi_totals(kpis: DataFrame) -> DataFrame:
    """Revenue, volume and average ticket over KPI rows, 0 where there is none."""
    volume = F.coalesce(F.sum("transaction_volume"), F.lit(0))
    revenue = F.coalesce(F.sum("total_revenue"), F.lit(0.0))
    return kpis.agg(
        F.round(revenue, 2).alias("total_revenue"), volume.alias("transaction_volume")
    ).withColumn(
        "average_ticket",
        F.when(
            F.col("transaction_volume") > 0,
            F.round(F.col("total_revenue") / F.col("transaction_volume"), 2),
        ).otherwise(F.lit(0.0)),
    )


def distinct_categories(kpis: DataFrame) -> DataFrame:
    return kpis.select("category").distinct()


def active_customers(silver: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of customers with a transaction."""
    counted = F.approx_count_distinct if approximate else F.count_distinct
    return silver.agg(counted("customer_id").alias("active_customers"))


#: Registers of a customer sketch, as a power of two, and the relative error that its
#: estimates keep: five standard errors of such a sketch, 1.04 / sqrt(2 ** 14).
SKETCH_BITS, SKETCH_ERROR = 14, 0.041


def customer_sketches(silver: DataFrame, day: str) -> DataFrame:
    """One sketch of the customers of each day, of some 16 KB whatever their number.

    Sketches of any days can be merged: replace a day's sketch with the day, and never
    read Silver for a distinct count over a span. Rows without a customer are not counted.
    """
    sketch = F.hll_sketch_agg("customer_id", SKETCH_BITS).alias("customers")
    return silver.filter(F.col("customer_id").isNotNull()).groupBy(day).agg(sketch)


def customers_from_sketches(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Estimated distinct customers over all the sketches, or for each group of them."""
    merged = F.hll_union_agg("customers", F.lit(False))
    estimate = F.coalesce(F.hll_sketch_estimate(merged), F.lit(0))
    return sketches.groupBy(*by).agg(estimate.alias("active_customers"))


def alert_count(alert_rows: DataFrame) -> DataFrame:
    return alert_rows.agg(F.count("*").alias("alert_count"))


def alerts_daily_change(alert_rows: DataFrame) -> DataFrame:
    """Alerts per day and percent change from the calendar day before.

    Every day's count is also sent to the day after, so one more small grouping
    brings both together without a self-join or a window over all days. The
    change is NULL when the day before had no alerts.
    """
    daily = alert_rows.groupBy("dt_particao").agg(F.count("*").alias("n"))
    entries = F.array(
        F.struct(
            F.col("dt_particao").alias("day"),
            F.col("n").alias("today"),
            F.lit(None).cast("long").alias("yesterday"),
        ),
        F.struct(
            F.date_add("dt_particao", 1).alias("day"),
            F.lit(None).cast("long").alias("today"),
            F.col("n").alias("yesterday"),
        ),
    )
    change = F.try_divide(
        (F.col("alert_count") - F.col("previous_count")) * 100.0, F.col("previous_count")
    )
    return (
        daily.select(F.inline(entries))
        .groupBy(F.col("day").alias("dt_particao"))
        .agg(F.max("today").alias("alert_count"), F.max("yesterday").alias("previous_count"))
        .filter(F.col("alert_count").isNotNull())
        .withColumn("pct_change", F.round(change, 2))
    )


def one_profile_each(profiles: DataFrame) -> DataFrame:
    """One row for each customer: of several the one with most devices, then the largest.

    Store it before a join with transactions: above an aggregate Spark could not split
    a customer's rows among tasks.
    """
    others = [c for c in profiles.columns if c != "cust_id"]
    ranked = F.struct(F.size("known_devices").alias("devices"), *others)
    best = profiles.groupBy("cust_id").agg(F.max(ranked).alias("p"))
    return best.select("cust_id", *(F.col("p")[c].alias(c) for c in others))


def enrich_with_profiles(silver: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add tier, home city and products; transactions without profile get NULLs.

    ``profiles`` has one row for each customer. No broadcast hint, for the reason given
    at ``device_mismatch``.
    """
    dimension = profiles.select(
        F.col("cust_id").cast("string").alias("customer_id"),
        "loyalty_tier",
        "home_city",
        "active_products",
    )
    return silver.join(dimension, "customer_id", "left")


def product_segments(profiles: DataFrame) -> DataFrame:
    """Customers per active product."""
    return (
        profiles.select("cust_id", F.explode("active_products").alias("product"))
        .groupBy("product")
        .agg(F.count_distinct("cust_id").alias("customers"))
    )
