from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import devices, gold, history
from frames import START, at, enriched_rows

DAY = 86400


def snapshots(spark, rows):
    """Rows of (customer, days after the start, devices, tier)."""
    full = [(c, None if d is None else at(d * DAY).date(), k, t) for c, d, k, t in rows]
    kinds = "cust_id int, snapshot_date date, known_devices array<string>, loyalty_tier string"
    return spark.createDataFrame(full, kinds)


def use(tx, customer, seconds, device="d1"):
    return (tx, customer, seconds, "App", None, None, device)


ROWS = [
    use("before", "1", -DAY),
    use("same_day", "1", 0),
    use("between", "1", 3 * DAY),
    use("after", "1", 9 * DAY),
    use("stranger", "2", 0),
    use("nobody", None, 0),
    use("twice", "1", 3 * DAY),
    use("twice", "1", 3 * DAY),
]
DATED = [
    (1, 0, ["d1"], "Silver"),
    (1, 5, ["d2"], "Gold"),
    (3, 0, ["d1"], "Gold"),
    (None, 0, ["d1"], "Gold"),
    (1, None, ["d1"], "Gold"),
]


def test_profile_of_the_day(spark):
    rows = enriched_rows(spark, ROWS)
    out = history.profiles_as_of(rows, snapshots(spark, DATED), ["loyalty_tier"])
    assert out.columns == [*rows.columns, "loyalty_tier", "snapshot_date"]
    found = sorted((r.transaction_id, r.loyalty_tier, r.snapshot_date) for r in out.collect())
    first, second = START.date(), at(5 * DAY).date()
    assert found == [
        ("after", "Gold", second),
        ("before", None, None),
        ("between", "Silver", first),
        ("nobody", None, None),
        ("same_day", "Silver", first),
        ("stranger", None, None),
        ("twice", "Silver", first),
        ("twice", "Silver", first),
    ]


def test_a_later_snapshot_changes_no_earlier_alert(spark):
    rows = enriched_rows(spark, ROWS)

    def alerts(dated):
        out = devices.device_mismatch_as_of(rows, snapshots(spark, dated))
        assert out.columns == [*rows.columns, "device_status", "criticality"]
        return {r.transaction_id: r.device_status for r in out.collect()}

    early = alerts([x for x in DATED if x[1] == 0])
    late = alerts(DATED)
    assert early == {
        "before": "NO_PROFILE",
        "stranger": "NO_PROFILE",
        "nobody": "NO_PROFILE",
    }
    assert late == early | {"after": "UNKNOWN_DEVICE"}


def test_two_profiles_of_one_day_and_empty_tables(spark):
    rows = enriched_rows(spark, ROWS[:3])
    both = [(1, 0, ["d1"], "Gold"), (1, 0, ["d1"], "Silver"), (1, 0, None, None)]
    tiers = history.profiles_as_of(rows, snapshots(spark, both), ["loyalty_tier"])
    assert {r.loyalty_tier for r in tiers.collect()} == {None, "Silver"}
    assert history.profiles_as_of(rows, snapshots(spark, []), ["loyalty_tier"]).count() == 3
    assert history.profiles_as_of(enriched_rows(spark, []), snapshots(spark, both), ["loyalty_tier"]).count() == 0


def slow_counts(rows, within):
    found = []
    for tx, customer, second, *_, device in rows:
        if device is None or customer is None:
            continue
        near = {c for _, c, s, *_, d in rows if d == device and c and abs(s - second) <= within}
        found.append((tx, len(near - {customer})))
    return sorted(found)


@pytest.mark.parametrize(("within", "slice_seconds"), [(600, DAY), (7, 10), (25, 10), (0, 10)])
def test_number_of_other_customers(spark, within, slice_seconds):
    rnd = random.Random(within)
    span = 60 if slice_seconds == 10 else 4 * DAY
    rows = [
        use(f"t{i}", rnd.choice(["1", "2", "3", "4", None]), rnd.randrange(-span, span), rnd.choice(["x", "y", None]))
        for i in range(150)
    ]
    rows += [use(f"b{i}", f"c{i % 9}", DAY - START.hour * 3600 + i, "busy") for i in range(60)]
    rows += rows[:5]
    frame = enriched_rows(spark, rows)
    out = devices.shared_key_counts(frame, "device_id", within, slice_seconds)
    assert out.columns == [*frame.columns, "other_customers"]
    assert sorted((r.transaction_id, r.other_customers) for r in out.collect()) == slow_counts(rows, within)


def test_counts_agree_with_the_shared_uses(spark):
    rnd = random.Random(5)
    rows = [use(f"t{i}", str(rnd.randrange(5)), rnd.randrange(3 * DAY), str(rnd.randrange(9))) for i in range(200)]
    frame = enriched_rows(spark, rows)
    shared = {r.transaction_id for r in devices.shared_key_events(frame, "device_id").collect()}
    counted = devices.shared_key_counts(frame, "device_id").filter("other_customers > 0")
    assert {r.transaction_id for r in counted.collect()} == shared
    assert devices.shared_key_counts(frame.limit(0), "device_id").count() == 0


def test_sketches_of_days_merge_over_any_span(spark):
    days = spark.range(60_000).select(
        (F.col("id") % 20_000).cast("string").alias("customer_id"),
        F.date_add(F.lit(date(2026, 3, 1)), (F.col("id") % 7).cast("int")).alias("day"),
    )
    days = days.unionByName(spark.createDataFrame([(None, date(2026, 3, 1))], days.schema))
    sketches = gold.customer_sketches(days, "day")
    assert sketches.count() == 7
    for last in (1, 3, 7):
        until = F.col("day") < F.lit(date(2026, 3, 1 + last))
        (found,) = gold.customers_from_sketches(sketches.filter(until)).collect()
        exact = days.filter(until).agg(F.count_distinct("customer_id")).head()[0]
        assert abs(found.active_customers - exact) <= gold.SKETCH_ERROR * exact
    (none,) = gold.customers_from_sketches(sketches.limit(0)).collect()
    assert none.active_customers == 0
