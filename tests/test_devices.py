from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import devices, gold, quality
from conftest import plan_of
from frames import enriched_rows, ids, profile_rows


def test_device_mismatch(spark):
    rows = enriched_rows(
        spark,
        [
            ("known", "1", 0, "App", None, None, "d1"),
            ("unknown", "1", 0, "Online", None, None, "d9"),
            ("no_device", "1", 0, "App", None, None, None),
            ("no_profile", "3", 0, "App", None, None, "d1"),
            ("in_store", "1", 0, "Físico", "Aveiro", None, "d9"),
        ],
    )
    known = profile_rows(spark, [(1, "Gold", "Aveiro", ["p"], ["d1", "d2"])])
    out = devices.device_mismatch(rows, known)
    assert {r["transaction_id"]: (r["device_status"], r["criticality"]) for r in out.collect()} == {
        "unknown": (devices.UNKNOWN_DEVICE, "high"),
        "no_device": (devices.NO_DEVICE, "high"),
        "no_profile": (devices.NO_PROFILE, "high"),
    }
    assert "in_store" in ids(devices.device_mismatch(rows, known, channels=None))


def uses(spark, rows):
    return enriched_rows(
        spark, [(tx, c, s, "App", None, device, device) for tx, c, s, device in rows]
    )


def test_shared_device(spark):
    rows = uses(
        spark,
        [
            ("a1", "1", 0, "x"),
            ("a2", "2", 300, "x"),  # two customers, five minutes apart
            ("b1", "1", 0, "y"),
            ("b2", "1", 10, "y"),  # one customer twice
            ("c1", "1", 0, "z"),
            ("c2", "2", 86400, "z"),  # two customers, a day apart
            ("d1", "1", 0, None),
            ("d2", "2", 0, None),  # no device
            ("e1", "1", 0, "limit"),
            ("e2", "2", 600, "limit"),
            ("f1", "1", 0, "beyond"),
            ("f2", "2", 601, "beyond"),
        ],
    )
    assert ids(devices.shared_key_events(rows, "device_id")) == ["a1", "a2", "e1", "e2"]
    assert ids(devices.shared_key_events(rows, "ip_address")) == ["a1", "a2", "e1", "e2"]


def random_uses(seed, n=400, span=20000):
    rng = random.Random(seed)
    return [
        (f"{i:04d}", str(rng.randrange(4)), rng.randrange(span), rng.choice(["h", "h", "d1", "d2"]))
        for i in range(n)
    ]


def brute_force(rows):
    return sorted(
        a[0]
        for a in rows
        if any(a[3] == b[3] and a[1] != b[1] and abs(a[2] - b[2]) <= 600 for b in rows)
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_device_matches_brute_force(spark, seed):
    rows = random_uses(seed, n=150) + [(f"t{i}", str(i % 2), 50000, "tied") for i in range(4)]
    want = brute_force(rows)
    assert 0 < len(want) < len(rows)
    assert ids(devices.shared_key_events(uses(spark, rows), "device_id")) == want


@pytest.mark.parametrize("slice_seconds", [1200, 5000, 86400])
def test_large_devices_match_brute_force(spark, all_hot, slice_seconds):
    rows = random_uses(slice_seconds, n=150)
    got = devices.shared_key_events(
        uses(spark, rows), "device_id", slice_seconds=slice_seconds, policy=all_hot
    )
    assert ids(got) == brute_force(rows)


def test_shared_device_plans(spark, all_hot):
    rows = uses(spark, random_uses(1))
    plain = plan_of(devices.shared_key_events(rows, "device_id"))
    assert plain.count("Exchange") == 1
    large = plan_of(devices.shared_key_events(rows, "device_id", policy=all_hot))
    assert "partial_min" in large
    assert "Cartesian" not in plain + large and "NestedLoop" not in plain + large


def test_slices_shorter_than_the_window_are_refused(spark):
    with pytest.raises(ValueError, match="slice_seconds"):
        devices.shared_key_events(uses(spark, random_uses(1)), "device_id", slice_seconds=1000)


def test_pairs_are_consecutive(spark, all_hot):
    rows = uses(
        spark,
        [
            ("a", "1", 0, "x"),
            ("b", "1", 10, "x"),
            ("c", "2", 20, "x"),
            ("d", "3", 30, "x"),
            ("e", "1", 5000, "x"),
        ],
    )
    for policy in ({}, {"policy": all_hot}):
        got = devices.shared_key_pairs(rows, "device_id", **policy).collect()
        assert sorted((r["prev_transaction_id"], r["transaction_id"], r["gap_seconds"]) for r in got) == [
            ("b", "c", 10),
            ("c", "d", 10),
        ]


def test_every_shared_device_has_a_pair(spark):
    rows = uses(spark, random_uses(8))
    shared = {r[0] for r in devices.shared_key_events(rows, "device_id").select("device_id").collect()}
    paired = {r[0] for r in devices.shared_key_pairs(rows, "device_id").select("device_id").collect()}
    assert shared == paired


def test_one_customer_with_a_third_of_the_rows_is_split(spark, tmp_path):
    number = F.col("id")
    spark.range(0, 200_000, 1, 8).select(
        number.cast("string").alias("transaction_id"),
        F.when(number % 3 == 0, "7")
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(3000)).cast("string"))
        .alias("customer_id"),
        F.lit("App").alias("channel"),
        (number % 100).cast("string").alias("device_id"),
    ).write.parquet(str(tmp_path / "rows"))
    spark.range(3000).select(
        F.col("id").alias("cust_id"),
        F.array(F.lit("5")).alias("known_devices"),
        F.lit("Gold").alias("loyalty_tier"),
        F.lit("Aveiro").alias("home_city"),
        F.array(F.lit("p")).alias("active_products"),
    ).write.parquet(str(tmp_path / "profiles"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    known = spark.read.parquet(str(tmp_path / "profiles"))
    parents = known.select(F.col("cust_id").cast("string").alias("id"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        for joined in (
            devices.device_mismatch(rows, known),
            gold.enrich_with_profiles(rows, known),
            quality.orphans(rows, "customer_id", parents, "id"),
        ):
            joined.collect()
            assert "SortMergeJoin(skew=true)" in plan_of(joined)
    finally:
        for name in small:
            spark.conf.unset(name)
