"""Device and IP rules: unknown devices, and keys shared between customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.operators.fraud import DAY_SECONDS
from cardwarden.operators.history import profiles_as_of
from cardwarden.operators.sequence import with_previous
from cardwarden.operators.skew import DEFAULT_SKEW, SkewPolicy, hot_keys, split_hot

# Channels without a physical store.
DIGITAL_CHANNELS = ("Online", "App")

# How close in time two uses of one device by different customers must be.
SHORT_TIME_SECONDS = 600

UNKNOWN_DEVICE = "UNKNOWN_DEVICE"
NO_PROFILE = "NO_PROFILE"
NO_DEVICE = "NO_DEVICE"


def device_mismatch(
    enriched: DataFrame,
    profiles: DataFrame,
    channels: Sequence[str] | None = DIGITAL_CHANNELS,
) -> DataFrame:
    """Digital transactions from a device their customer's profile does not list.

    Every one is of high criticality. A customer without profile is reported as
    such, and so is a transaction without a device. ``profiles`` has one row for each
    customer (``gold.one_profile_each``). Pass ``channels=None`` to check all channels. The join carries no
    broadcast hint: profiles grow with the customer base, so Spark decides by
    their measured size, and splits skewed customers if it has to sort-merge.
    """
    checked = enriched if channels is None else enriched.filter(F.col("channel").isin(*channels))
    trusted = profiles.select(
        F.col("cust_id").cast("string").alias("customer_id"),
        "known_devices",
        F.lit(True).alias("has_profile"),
    )
    return _untrusted(checked.join(trusted, "customer_id", "left")).drop(
        "known_devices", "has_profile"
    )


def _untrusted(checked: DataFrame) -> DataFrame:
    """Rows whose device is not among their ``known_devices``, with the reason."""
    known = F.coalesce(F.array_contains("known_devices", F.col("device_id")), F.lit(False))
    status = (
        F.when(F.col("device_id").isNull(), NO_DEVICE)
        .when(F.col("has_profile"), UNKNOWN_DEVICE)
        .otherwise(NO_PROFILE)
    )
    return checked.filter(~known).withColumns(
        {"device_status": status, "criticality": F.lit("high")}
    )


def device_mismatch_as_of(
    enriched: DataFrame,
    snapshots: DataFrame,
    channels: Sequence[str] | None = DIGITAL_CHANNELS,
) -> DataFrame:
    """``device_mismatch`` against the profile that held on the day of the transaction.

    ``snapshots`` are dated profiles (``history.profiles_as_of``): a later one changes no
    earlier alert, and before a customer's first one there is no profile.
    """
    checked = enriched if channels is None else enriched.filter(F.col("channel").isin(*channels))
    dated = profiles_as_of(checked, snapshots, ["known_devices"]).withColumn(
        "has_profile", F.col("snapshot_date").isNotNull()
    )
    return _untrusted(dated).drop("known_devices", "has_profile", "snapshot_date")


def _near_other_customer(
    uses: DataFrame, keys: Sequence[str], tie: str, within_seconds: int
) -> DataFrame:
    """Uses near another customer's use of the same keys, by neighbours in sequence.

    The closest earlier use by another customer is the last row of the run of
    equal customers before this one. It is carried along the run, and likewise
    backwards for the closest later use. One pass each way, whatever the number
    of uses within the time.
    """
    forward = Window.partitionBy(*keys).orderBy("_second", tie)
    backward = Window.partitionBy(*keys).orderBy(F.desc("_second"), F.desc(tie))
    stepped = uses.select(
        "*",
        F.lag("customer_id").over(forward).alias("_customer_before"),
        F.lag("_second").over(forward).alias("_second_before"),
        F.lead("customer_id").over(forward).alias("_customer_after"),
        F.lead("_second").over(forward).alias("_second_after"),
    )

    def other(side: str) -> Column:
        changed = F.col("customer_id") != F.col(f"_customer_{side}")
        return F.when(changed, F.col(f"_second_{side}"))

    so_far = (Window.unboundedPreceding, Window.currentRow)
    earlier = F.last(other("before"), ignorenulls=True).over(forward.rowsBetween(*so_far))
    later = F.last(other("after"), ignorenulls=True).over(backward.rowsBetween(*so_far))
    return stepped.select("*", earlier.alias("_earlier"), later.alias("_later")).filter(
        (F.col("_second") - F.col("_earlier") <= within_seconds)
        | (F.col("_later") - F.col("_second") <= within_seconds)
    )


def _near_other_customer_in_slices(
    timed: DataFrame, key: str, within_seconds: int, slice_seconds: int
) -> DataFrame:
    """The same rows for keys of any size.

    Whether a key has a second customer near a second shows from the lowest and
    the highest customer of each second, so events are first reduced to those.
    Each key's time is cut into slices, and seconds near a cut are copied to the
    slice across it. A group to search then has at most two rows for each of
    ``slice_seconds + 2 * within_seconds``, however many events a key has.
    """

    def slice_of(seconds: Column) -> Column:
        return F.floor(seconds / slice_seconds)

    at = F.col("_second")
    slices = F.sequence(slice_of(at - within_seconds), slice_of(at + within_seconds))
    reduced = (
        timed.groupBy(key, "_second")
        .agg(F.min("customer_id").alias("_low"), F.max("customer_id").alias("_high"))
        .select(key, "_second", "_low", "_high", F.explode(slices).alias("_slice"))
        .select(
            key,
            "_second",
            "_slice",
            F.explode(F.array_distinct(F.array("_low", "_high"))).alias("customer_id"),
        )
    )
    shared = (
        _near_other_customer(reduced, [key, "_slice"], "customer_id", within_seconds)
        .filter(F.col("_slice") == slice_of(at))
        .select(key, "_second")
    )
    return timed.join(shared, [key, "_second"], "left_semi")


def shared_key_events(
    enriched: DataFrame,
    key: str,
    within_seconds: int = SHORT_TIME_SECONDS,
    slice_seconds: int = DAY_SECONDS,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Transactions whose device (or IP) another customer used within the time."""
    if slice_seconds < 2 * within_seconds:
        raise ValueError("slice_seconds must be at least twice within_seconds")
    timed = enriched.filter(F.col(key).isNotNull() & F.col("customer_id").isNotNull()).withColumn(
        "_second", F.unix_timestamp("transaction_date")
    )
    hot = hot_keys(timed, key, policy)
    if hot is None:
        found = _near_other_customer(timed, [key], "transaction_id", within_seconds)
        return found.select(*enriched.columns)
    rest, large = split_hot(timed, key, hot)
    found = _near_other_customer(rest, [key], "transaction_id", within_seconds)
    in_large = _near_other_customer_in_slices(large, key, within_seconds, slice_seconds)
    return found.select(*enriched.columns).unionByName(in_large.select(*enriched.columns))


def shared_key_pairs(
    enriched: DataFrame,
    key: str,
    within_seconds: int = SHORT_TIME_SECONDS,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Consecutive uses of a key by two customers within the time.

    Each transaction pairs with at most the one before it on the same key, so
    output grows with the input and not with its square. No sharing is missed:
    between any two uses within the time by different customers, some step of
    the sequence changes customer.
    """
    timed = enriched.filter(F.col(key).isNotNull() & F.col("customer_id").isNotNull()).select(
        key,
        "transaction_id",
        "customer_id",
        "transaction_date",
        F.unix_timestamp("transaction_date").alias("_second"),
    )
    stepped = with_previous(
        timed,
        key,
        ["transaction_date", "transaction_id"],
        {
            "prev_transaction_id": F.col("transaction_id"),
            "prev_customer_id": F.col("customer_id"),
            "_prev_second": F.col("_second"),
        },
        policy,
    )
    gap = F.col("_second") - F.col("_prev_second")
    return (
        stepped.withColumn("gap_seconds", gap)
        .filter(
            (F.col("customer_id") != F.col("prev_customer_id"))
            & (F.col("gap_seconds") <= within_seconds)
        )
        .select(
            key,
            "prev_transaction_id",
            "prev_customer_id",
            "transaction_id",
            "customer_id",
            "gap_seconds",
        )
    )


def shared_key_counts(
    enriched: DataFrame,
    key: str,
    within_seconds: int = SHORT_TIME_SECONDS,
    slice_seconds: int = DAY_SECONDS,
) -> DataFrame:
    """Each use of a key with the number of other customers who used it within the time.

    A customer is near a second if one of their uses is within the time of it. Their uses
    thus make spans, which are merged where they meet; a span's start adds one customer
    to those near, its end takes one away, and the running sum over a key's seconds is
    the count. No pairs of uses are made, so the work is linear in the input.

    Spans are cut at the borders of time slices and every slice is counted alone. A group
    has a row for each second of a slice at most, however many uses the key or the customer
    has. The counts then go back to the transactions by key and second.

    Returns the rows that have the key, a customer and a time, and ``other_customers``.
    Several uses by one customer count once; a transaction listed twice stays twice.
    """
    if slice_seconds < 1 or within_seconds < 0:
        raise ValueError("slice_seconds must be positive and within_seconds not negative")
    second = F.unix_timestamp("transaction_date")
    used = F.col(key).isNotNull() & F.col("customer_id").isNotNull() & second.isNotNull()
    timed = enriched.filter(used).withColumn("_second", second)

    def slice_of(seconds: Column) -> Column:
        return F.floor(seconds / slice_seconds)

    at, begins = F.col("_second"), F.col("_slice") * slice_seconds
    near = F.sequence(slice_of(at - within_seconds), slice_of(at + within_seconds))
    spans = (
        timed.select(F.col(key).alias("_key"), "customer_id", "_second")
        .distinct()
        .select("*", F.explode(near).alias("_slice"))
        .select(
            "*",
            F.greatest(at - within_seconds, begins).alias("_start"),
            F.least(at + within_seconds, begins + (slice_seconds - 1)).alias("_stop"),
        )
    )
    by_customer = Window.partitionBy("_key", "_slice", "customer_id").orderBy("_second")
    spans = spans.withColumns(
        {
            "_before": F.lag("_stop").over(by_customer),
            "_after": F.lead("_start").over(by_customer),
        }
    )
    before, after = F.col("_before"), F.col("_after")

    def change(when: Column, by: int, use: bool = False) -> Column:
        return F.struct(when.alias("_at"), F.lit(by).alias("_by"), F.lit(use).alias("_use"))

    start, stop = F.col("_start"), F.col("_stop")
    changes = F.array(
        F.when(before.isNull() | (before < start), change(start, 1)),
        F.when(after.isNull() | (after > stop), change(stop + 1, -1)),
        F.when(F.col("_slice") == slice_of(at), change(at, 0, use=True)),
    )
    running = Window.partitionBy("_key", "_slice").orderBy("_at")
    counted = (
        spans.select("_key", "_slice", F.explode(changes).alias("_change"))
        .filter(F.col("_change").isNotNull())
        .select("_key", "_slice", "_change.*")
        .groupBy("_key", "_slice", "_at")
        .agg(F.sum("_by").alias("_by"), F.max("_use").alias("_use"))
        .withColumn("_near", F.sum("_by").over(running))
        .filter("_use")
        .select(
            F.col("_key").alias(key),
            F.col("_at").alias("_second"),
            (F.col("_near") - 1).alias("other_customers"),
        )
    )
    return timed.join(counted, [key, "_second"]).select(*enriched.columns, "other_customers")
