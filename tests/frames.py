"""Small hand-made tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from cardwarden import schemas

START = datetime(2026, 3, 31, 11, 35, 2)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def silver_rows(spark, rows):
    """Rows of (id, customer, seconds, latitude, longitude[, amount, category])."""
    full = []
    for row in rows:
        tx, customer, seconds, lat, lon, *rest = row
        amount, category = rest if rest else (10.0, "Lazer")
        when = None if seconds is None else at(seconds)
        full.append((tx, customer, amount, when, category, lat, lon, START))
    return spark.createDataFrame(full, schemas.SILVER)


def enriched_rows(spark, rows):
    """Rows of (id, customer, seconds, channel, city, ip, device)."""
    full = [
        (tx, customer, 10.0, at(seconds), "Lazer", None, None, START, channel, city, ip, device)
        for tx, customer, seconds, channel, city, ip, device in rows
    ]
    return spark.createDataFrame(full, schemas.SILVER_ENRICHED)


def bronze_rows(spark, rows):
    """Rows of (tx_id, cust_id, datetime text, amount text)."""
    full = [(i, c, d, a, "Lazer", "App", "N/A", "1.2.3.4", "d1") for i, c, d, a in rows]
    return spark.createDataFrame(full, schemas.BRONZE)


def profile_rows(spark, rows):
    """Rows of (customer, tier, city, products, devices)."""
    full = [(c, f"Name {c}", tier, city, products, known) for c, tier, city, products, known in rows]
    return spark.createDataFrame(full, schemas.PROFILE)


def ids(df, column="transaction_id"):
    return sorted(r[column] for r in df.select(column).collect())
