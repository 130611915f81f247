from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.operators import silver
from conftest import plan_of
from frames import bronze_rows, ids

NOW = datetime(2026, 4, 1)


def test_refine_types_names_and_null_key(spark):
    raw = bronze_rows(
        spark,
        [
            ("t1", "1001", "2026-03-31 11:35:02", "12,5"),
            ("t2", "1001", "31/03/2026", "abc"),
            (None, "1001", "2026-03-31 11:35:02", "1.0"),
        ],
    )
    out = silver.refine(raw, NOW)
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in schemas.SILVER
    ]
    rows = {r["transaction_id"]: r for r in out.collect()}
    assert set(rows) == {"t1", "t2"}
    assert rows["t1"]["amount"] == 12.5
    assert rows["t1"]["transaction_date"] == datetime(2026, 3, 31, 11, 35, 2)
    assert rows["t1"]["latitude"] is None
    assert rows["t2"]["amount"] is None
    assert rows["t2"]["transaction_date"] is None


def test_refine_keeps_source_coordinates(spark):
    raw = bronze_rows(spark, [("t1", "1", "2026-03-31 11:35:02", "1")]).withColumns(
        {"latitude": F.lit("38.7"), "longitude": F.lit("bad")}
    )
    row = silver.refine(raw, NOW).first()
    assert (row["latitude"], row["longitude"]) == (38.7, None)


def test_refine_enriched_clears_sentinels(spark):
    row = silver.refine_enriched(
        bronze_rows(spark, [("t1", "1", "2026-03-31 11:35:02", "1")]), NOW
    ).first()
    assert row["location_city"] is None
    assert (row["ip_address"], row["device_id"], row["channel"]) == ("1.2.3.4", "d1", "App")


def test_refine_does_not_shuffle(spark):
    assert "Exchange" not in plan_of(silver.refine(bronze_rows(spark, []), NOW))


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 3, 30.0), ("a", 2, 20.0), ("b", 1, 1.0)],
        "transaction_id string, version int, amount double",
    )
    out = silver.latest_per_key(df, ["transaction_id"], [F.desc("version")])
    assert ids(out) == ["a", "b"]
    assert out.filter("transaction_id = 'a'").first()["amount"] == 30.0


def test_latest_per_key_limits_below_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    plan = plan_of(silver.latest_per_key(df, ["k"], [F.desc("v")]))
    assert "row_number(), 1, Partial" in plan
