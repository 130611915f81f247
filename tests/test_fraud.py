from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.operators import fraud
from conftest import plan_of
from frames import enriched_rows, ids, silver_rows

# About 111.195 km per degree along the equator.
KM_PER_DEGREE = 111.19492664455873


def flags(spark, rows, preset):
    out = fraud.flag(fraud.travel_metrics(silver_rows(spark, rows)), preset)
    return {
        r["transaction_id"]: (r["is_impossible_travel"], r["is_velocity_fraud"])
        for r in out.collect()
    }


def step(seconds, degrees):
    return [("a", "1", 0, 0.0, 0.0), ("b", "1", seconds, 0.0, degrees)]


def test_first_transaction_is_never_flagged(spark):
    rows = [("a", "1", 0, 1.0, 1.0), ("b", "2", 0, None, None)]
    for preset in fraud.PRESETS:
        assert set(flags(spark, rows, preset).values()) == {(False, False)}


@pytest.mark.parametrize(("seconds", "quick"), [(0, True), (86399, True), (86400, False)])
def test_velocity_boundary(spark, seconds, quick):
    assert flags(spark, step(seconds, 0.0), "distance_5km")["b"][1] is quick


@pytest.mark.parametrize(
    ("km", "seconds", "hit"), [(4.99, 60, False), (5.01, 60, True), (5.01, 0, False)]
)
def test_distance_boundary(spark, km, seconds, hit):
    assert flags(spark, step(seconds, km / KM_PER_DEGREE), "distance_5km")["b"][0] is hit


@pytest.mark.parametrize(
    ("km", "seconds", "hit"),
    [(799.0, 3600, False), (801.0, 3600, True), (1.0, 0, True), (0.0, 0, False)],
)
def test_speed_boundary(spark, km, seconds, hit):
    got = flags(spark, step(seconds, km / KM_PER_DEGREE), "strict")
    assert got["b"] == (hit, False)


def test_exact_limits_of_distance_and_speed_do_not_count(spark):
    metrics = spark.createDataFrame(
        [(5.0, 60, 60 / 3600.0), (800.0, 3600, 1.0)],
        "dist_km double, diff_seconds long, time_diff_hours double",
    ).withColumns(
        {
            c: F.lit(0.0)
            for c in ("latitude", "longitude", "prev_latitude", "prev_longitude")
        }
    )
    assert not fraud.flag(metrics.limit(1), "distance_5km").first()["is_impossible_travel"]
    assert not any(r["is_impossible_travel"] for r in fraud.flag(metrics, "strict").collect())


def test_unknown_positions(spark):
    rows = [("a", "1", 0, None, None), ("b", "1", 60, 10.0, 10.0), ("c", "1", 120, None, 1.0)]
    metrics = fraud.travel_metrics(silver_rows(spark, rows))
    assert {r["dist_km"] for r in metrics.collect()} == {0.0}
    assert not any(travel for travel, _ in flags(spark, rows, "strict").values())
    assert flags(spark, rows, "permissive")["b"] == (True, True)


def test_reasons(spark):
    rows = [
        ("a", "1", 0, 0.0, 0.0),
        ("b", "1", 60, 0.0, 1.0),  # far and quick
        ("c", "1", 61, 0.0, 1.0),  # quick only
        ("d", "1", 200000, 0.0, 2.0),  # far only
        ("e", "1", 400000, 0.0, 2.0),  # neither
    ]
    found = fraud.fraud_alerts(silver_rows(spark, rows), "distance_5km")
    assert found.columns == schemas.ALERT.fieldNames()
    assert {r["transaction_id"]: r["fraud_reason"] for r in found.collect()} == {
        "b": fraud.BOTH,
        "c": fraud.VELOCITY,
        "d": fraud.TRAVEL,
    }


def tied_rows():
    rng = random.Random(3)
    return [
        (f"t{i:03d}", str(i % 7), rng.choice([0, 86400]), rng.uniform(-60, 60), rng.uniform(-60, 60))
        for i in range(120)
    ]


def test_ties_do_not_depend_on_input_order(spark):
    rows = tied_rows()
    shuffled = rows[:]
    random.Random(9).shuffle(shuffled)
    one = fraud.fraud_alerts(silver_rows(spark, rows), "strict").collect()
    other = fraud.fraud_alerts(silver_rows(spark, shuffled).repartition(7), "strict").collect()
    assert sorted(map(str, one)) == sorted(map(str, other))


def test_large_customers_get_the_same_alerts(spark, all_hot):
    silver = silver_rows(spark, tied_rows())
    plain = fraud.fraud_alerts(silver, "distance_5km").collect()
    large = fraud.fraud_alerts(silver, "distance_5km", all_hot).collect()
    assert plain and sorted(map(str, plain)) == sorted(map(str, large))


def test_alerts_and_eligible_partition_the_transactions(spark):
    silver = silver_rows(spark, tied_rows())
    found = fraud.fraud_alerts(silver, "strict")
    eligible = fraud.reward_eligible(fraud.flag(fraud.travel_metrics(silver), "strict"))
    assert 0 < found.count() < silver.count()
    assert sorted(ids(found) + ids(eligible)) == ids(silver)


def test_bi_metrics(spark):
    found = fraud.fraud_alerts(silver_rows(spark, step(100, 1.0)), "distance_5km")
    out = fraud.bi_metrics(found)
    assert out.columns == schemas.BI_METRICS.fieldNames()
    row = out.first()
    assert (row["distancia_km"], row["tempo_minutos"]) == (111.19, 1.67)


def test_city_change_ignores_other_channels(spark, all_hot):
    rows = enriched_rows(
        spark,
        [
            ("a", "1", 0, "Físico", "Aveiro", None, "d"),
            ("b", "1", 600, "Online", None, "1.1.1.1", "d"),
            ("c", "1", 3600, "Físico", "Braga", None, "d"),
            ("d", "1", 7200, "Físico", "Braga", None, "d"),
            ("e", "1", 7200 + 86400, "Físico", "Lagos", None, "d"),
            ("f", "2", 0, "Físico", "Lagos", None, "d"),
        ],
    )
    assert ids(fraud.physical_city_changes(rows)) == ["c"]
    assert ids(fraud.physical_city_changes(rows, within_seconds=86401)) == ["c", "e"]
    assert ids(fraud.physical_city_changes(rows, policy=all_hot)) == ["c"]


def test_alert_plan_has_one_shuffle_and_no_python(spark):
    plan = plan_of(fraud.fraud_alerts(silver_rows(spark, tied_rows()), "strict"))
    assert plan.count("Exchange") == 1
    assert "Python" not in plan
