"""Fraud rules over each customer's sequence of transactions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.functions import haversine_km
from cardwarden.operators.sequence import with_previous
from cardwarden.operators.skew import DEFAULT_SKEW, SkewPolicy

DAY_SECONDS = 86_400
PHYSICAL_CHANNEL = "Físico"

# Alert reasons.
BOTH = "IMPOSSIBLE_TRAVEL_AND_VELOCITY"
TRAVEL = "IMPOSSIBLE_TRAVEL"
VELOCITY = "HIGH_VELOCITY"
UNKNOWN = "UNKNOWN"


@dataclass(frozen=True)
class Preset:
    """A rule set: when a move is impossible, and the velocity rule's limit.

    ``velocity_seconds=None`` turns the velocity rule off.
    """

    travel: Callable[[], Column]
    velocity_seconds: int | None = DAY_SECONDS


def _any_known_gap() -> Column:
    return (F.col("dist_km") >= 0) & (F.col("time_diff_hours") >= 0)


def _over_5_km() -> Column:
    return (F.col("dist_km") > 5) & (F.col("diff_seconds") > 0)


def _over_800_kmh() -> Column:
    # Multiplied out, so that a move in 0 s counts and nothing is divided by 0.
    # Unknown positions are excluded explicitly; their distance of 0 is a default.
    located = (
        F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & F.col("prev_latitude").isNotNull()
        & F.col("prev_longitude").isNotNull()
    )
    return located & (F.col("dist_km") > 800 * F.col("time_diff_hours"))


PRESETS = {
    "permissive": Preset(_any_known_gap),
    "distance_5km": Preset(_over_5_km),
    "strict": Preset(_over_800_kmh, velocity_seconds=None),
}


def travel_metrics(silver: DataFrame, policy: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
    """Add the customer's previous position and time, and the gap to them.

    Adds ``current_time_unix, prev_latitude, prev_longitude, prev_time_unix,
    dist_km, diff_seconds, time_diff_hours``. Order is by time, then id.
    """
    timed = silver.withColumn("current_time_unix", F.unix_timestamp("transaction_date"))
    stepped = with_previous(
        timed,
        "customer_id",
        ["transaction_date", "transaction_id"],
        {
            "prev_latitude": F.col("latitude"),
            "prev_longitude": F.col("longitude"),
            "prev_time_unix": F.col("current_time_unix"),
        },
        policy,
    )
    gap = F.col("current_time_unix") - F.col("prev_time_unix")
    return stepped.select(
        "*",
        haversine_km(
            F.col("latitude"), F.col("longitude"), F.col("prev_latitude"), F.col("prev_longitude")
        ).alias("dist_km"),
        gap.alias("diff_seconds"),
        (F.abs(gap) / 3600.0).alias("time_diff_hours"),
    )


def flag(metrics: DataFrame, preset: str = "strict") -> DataFrame:
    """Add ``is_impossible_travel``, ``is_velocity_fraud`` and ``is_fraud``.

    A rule that cannot be decided, as on a customer's first row, is false.
    """
    rules = PRESETS[preset]
    seconds = F.col("diff_seconds")
    quick = (
        F.lit(False)
        if rules.velocity_seconds is None
        else (seconds >= 0) & (seconds < rules.velocity_seconds)
    )
    return metrics.withColumns(
        {
            "is_impossible_travel": F.coalesce(rules.travel(), F.lit(False)),
            "is_velocity_fraud": F.coalesce(quick, F.lit(False)),
        }
    ).withColumn("is_fraud", F.col("is_impossible_travel") | F.col("is_velocity_fraud"))


def alerts(flagged: DataFrame) -> DataFrame:
    """The flagged rows with their reason and day, in the audit table's columns."""
    travel, quick = F.col("is_impossible_travel"), F.col("is_velocity_fraud")
    reason = (
        F.when(travel & quick, BOTH).when(travel, TRAVEL).when(quick, VELOCITY).otherwise(UNKNOWN)
    )
    return (
        flagged.filter(travel | quick)
        .withColumns({"fraud_reason": reason, "dt_particao": F.to_date("transaction_date")})
        .select(*schemas.ALERT.fieldNames())
    )


def fraud_alerts(
    silver: DataFrame, preset: str = "strict", policy: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    """Silver to alerts under a preset: one window, no Python in the data path."""
    return alerts(flag(travel_metrics(silver, policy), preset))


def bi_metrics(alert_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Alerts in the serving table's columns and ``keep``: km and minutes to two decimals."""
    return alert_rows.select(
        "customer_id",
        "transaction_date",
        F.col("amount").try_cast("double").alias("amount"),
        "category",
        "latitude",
        "longitude",
        F.round("dist_km", 2).alias("distancia_km"),
        F.round(F.col("diff_seconds") / 60, 2).alias("tempo_minutos"),
        "fraud_reason",
        *keep,
    )


def physical_city_changes(
    enriched: DataFrame,
    within_seconds: int = DAY_SECONDS,
    channel: str = PHYSICAL_CHANNEL,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """In-store transactions in another city than the customer's last in-store one.

    The channel filter comes before the sequence: transactions of other channels
    in between do not count as a previous one, and never reach the shuffle.
    """
    in_store = enriched.filter(F.col("channel") == channel).withColumn(
        "current_time_unix", F.unix_timestamp("transaction_date")
    )
    stepped = with_previous(
        in_store,
        "customer_id",
        ["transaction_date", "transaction_id"],
        {
            "prev_city": F.col("location_city"),
            "prev_time_unix": F.col("current_time_unix"),
        },
        policy,
    )
    gap = F.col("current_time_unix") - F.col("prev_time_unix")
    return (
        stepped.withColumn("diff_seconds", gap)
        .filter(
            (F.col("location_city") != F.col("prev_city"))
            & (F.col("diff_seconds") < within_seconds)
        )
        .drop("current_time_unix", "prev_time_unix")
    )


def reward_eligible(flagged: DataFrame) -> DataFrame:
    """Transactions that raised no alert: the flagged rows' complement, without a join."""
    return flagged.filter(~F.col("is_fraud"))
