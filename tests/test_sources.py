from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cardwarden import schemas, sources
from cardwarden.session import scratch_path
from conftest import plan_of
from frames import ids, silver_rows

HEADER = (
    "tx_id,cust_id,tx_datetime,tx_amount,tx_category,channel,location_city,ip_address,device_id"
)
GOOD = 't1,1001,2026-03-31 11:35:02,"12,5",Saúde,Físico,Aveiro,N/A,d1'
SHORT = "t2,1002,2026-03-31 11:35:02"
LONG = "t3,1003,2026-03-31 11:35:02,1.0,Lazer,App,N/A,1.2.3.4,d2,extra"


def write_lines(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_csv_scan_is_text_and_keeps_malformed_lines(spark, tmp_path):
    write_lines(tmp_path / "a.csv", HEADER, GOOD, SHORT, LONG)
    df = sources.read_transactions_csv(spark, str(tmp_path))
    assert [f.name for f in df.schema] == [*schemas.BRONZE.fieldNames(), "_corrupt_record"]
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    rows = {r["tx_id"]: r for r in df.collect()}
    assert rows["t1"]["tx_amount"] == "12,5"
    assert rows["t1"]["channel"] == "Físico"
    assert rows["t1"]["_corrupt_record"] is None
    assert rows["t2"]["_corrupt_record"] == SHORT
    assert rows["t3"]["_corrupt_record"] == LONG


def test_csv_scan_reads_names_not_positions(spark, tmp_path):
    write_lines(tmp_path / "a.csv", "latitude,cust_id,tx_id", "1.5,7,t1")
    row = sources.read_transactions_csv(spark, str(tmp_path)).first()
    assert (row["tx_id"], row["cust_id"], row["latitude"]) == ("t1", "7", "1.5")


def test_csv_scan_refuses_files_with_another_header(spark, tmp_path):
    write_lines(tmp_path / "a.csv", "tx_id,cust_id", "t1,1")
    write_lines(tmp_path / "b.csv", "cust_id,tx_id", "1,t1")
    with pytest.raises(Exception, match="CSV header does not conform"):
        sources.read_transactions_csv(spark, str(tmp_path)).collect()


def test_csv_scan_with_inference(spark, tmp_path):
    write_lines(tmp_path / "a.csv", "tx_id,cust_id,tx_amount", "t1,7,1.5")
    df = sources.read_transactions_csv(spark, str(tmp_path), infer=True)
    assert dict(df.dtypes) == {"tx_id": "string", "cust_id": "int", "tx_amount": "double"}


def test_profiles_from_array_and_from_lines(spark, tmp_path):
    one = '{"cust_id": 1, "known_devices": ["d1", "d2"], "active_products": ["p"]}'
    two = '{"cust_id": 2, "known_devices": [], "active_products": []}'
    (tmp_path / "array").mkdir()
    (tmp_path / "lines").mkdir()
    (tmp_path / "array" / "a.json").write_text(f"[\n  {one},\n  {two}\n]")
    (tmp_path / "lines" / "a.json").write_text(f"{one}\n{two}\n")
    array = sources.read_profiles(spark, str(tmp_path / "array"))
    lines = sources.read_profiles(spark, str(tmp_path / "lines"), multi_line=False)
    assert array.schema == lines.schema == schemas.PROFILE
    assert sorted(map(tuple, array.collect())) == sorted(map(tuple, lines.collect()))
    assert array.filter(F.array_contains("known_devices", "d2")).count() == 1


def test_landing_replaces_a_redelivered_file_only(spark, tmp_path):
    source, bronze = tmp_path / "in", str(tmp_path / "bronze")
    source.mkdir()
    write_lines(source / "transactions_20260330.csv", "tx_id,cust_id", "a1,1", "a2,1")
    write_lines(source / "transactions_20260331.csv", "tx_id,cust_id", "b1,1")
    sources.land_transactions(spark, str(source), bronze, datetime(2026, 4, 1))
    assert ids(sources.read_table(spark, bronze), "tx_id") == ["a1", "a2", "b1"]

    write_lines(source / "transactions_20260331.csv", "tx_id,cust_id", "b2,1", "b3,1")
    again = str(source / "transactions_20260331.csv")
    sources.land_transactions(spark, again, bronze, datetime(2026, 4, 2))
    landed = sources.read_table(spark, bronze)
    assert ids(landed, "tx_id") == ["a1", "a2", "b2", "b3"]
    assert {r[0].rpartition("/")[2] for r in landed.select("source_path").collect()} == {
        "transactions_20260330.csv",
        "transactions_20260331.csv",
    }
    assert dict(landed.dtypes)["ingested_at"] == "timestamp"


def test_landing_profiles(spark, tmp_path):
    (tmp_path / "p.json").write_text('[{"cust_id": 1, "name": "A"}]')
    sources.land_profiles(spark, str(tmp_path / "p.json"), str(tmp_path / "bronze"))
    row = sources.read_table(spark, str(tmp_path / "bronze")).first()
    assert row["cust_id"] == 1 and row["source_path"].endswith("/p.json")


def test_landing_keeps_files_of_one_name_in_two_folders(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    for day, key in (("d1", "a1"), ("d2", "b1")):
        (tmp_path / day).mkdir()
        write_lines(tmp_path / day / "transactions.csv", "tx_id,cust_id", f"{key},1")
        sources.land_transactions(spark, str(tmp_path / day), bronze)
    assert ids(sources.read_table(spark, bronze), "tx_id") == ["a1", "b1"]


def test_landing_an_emptied_file_removes_its_rows(spark, tmp_path):
    source, bronze = tmp_path / "in", str(tmp_path / "bronze")
    source.mkdir()
    write_lines(source / "a.csv", "tx_id,cust_id", "a1,1")
    write_lines(source / "b.csv", "tx_id,cust_id", "b1,1")
    sources.land_transactions(spark, str(source), bronze)
    write_lines(source / "a.csv", "tx_id,cust_id")
    sources.land_transactions(spark, str(source / "a.csv"), bronze)
    assert ids(sources.read_table(spark, bronze), "tx_id") == ["b1"]


def test_json_lines_read_as_an_array_are_an_error(spark, tmp_path):
    lines = tmp_path / "p.json"
    lines.write_text('{"cust_id": 1}\n{"cust_id": 2}\n')
    with pytest.raises(ValueError, match="JSON lines"):
        sources.read_profiles(spark, str(lines))
    lines.write_text('{\n "cust_id": 1\n}\n')
    assert sources.read_profiles(spark, str(lines)).count() == 1


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        def __init__(self, **settings):
            self.conf = settings

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(**{"spark.master": "spark://host:7077"}), "x")
    shared = Session(**{"spark.checkpoint.dir": "file:///mnt/shared/"})
    assert scratch_path(shared, "x").startswith("file:///mnt/shared/cardwarden-")


def test_replaced_days_become_empty(spark, tmp_path):
    path = str(tmp_path / "daily")
    silver = silver_rows(spark, [("a", "1", 0, None, None), ("b", "1", 86400, None, None)])
    daily = silver.withColumn("dt", F.to_date("transaction_date"))
    first, second = (date(2026, 3, 31), date(2026, 4, 1))
    sources.replace_days(daily, path, "dt", {first, second})
    sources.replace_days(daily.filter("transaction_id = 'z'"), path, "dt", {second})
    assert ids(sources.read_table(spark, path)) == ["a"]


def test_daily_sink_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = [("a", 0), ("b", 86400), ("c", 86400)]
    silver = silver_rows(spark, [(i, "1", s, None, None) for i, s in rows])
    daily = silver.withColumn("dt_particao", F.to_date("transaction_date"))
    assert sources.write_daily(daily, path) == 3
    assert sources.write_daily(daily.filter("amount < 0"), path) == 0
    later = daily.filter(F.col("transaction_id") == "b").withColumn("amount", F.lit(99.0))
    assert sources.write_daily(later, path) == 1
    stored = sources.read_table(spark, path)
    assert ids(stored) == ["a", "b"]
    assert stored.filter("transaction_id = 'b'").first()["amount"] == 99.0


def test_day_filter_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "daily")
    silver = silver_rows(spark, [("a", "1", 0, None, None), ("b", "1", 86400, None, None)])
    sources.write_daily(silver.withColumn("dt_particao", F.to_date("transaction_date")), path)
    one = sources.read_table(spark, path).filter(F.col("dt_particao") == date(2026, 3, 31))
    assert ids(one) == ["a"]
    assert "PartitionFilters: [isnotnull(dt_particao" in plan_of(one)


def test_rewriting_a_flat_table_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "flat")
    rows = silver_rows(spark, [("a", "1", 0, None, None)])
    sources.write_flat(rows, path)
    sources.write_flat(rows, path)
    assert ids(sources.read_table(spark, path)) == ["a"]


def test_read_or_empty(spark, tmp_path):
    missing = sources.read_or_empty(spark, str(tmp_path / "none"), schemas.ALERT)
    assert missing.schema == schemas.ALERT
    assert missing.count() == 0
    path = str(tmp_path / "flat")
    sources.write_flat(silver_rows(spark, [("a", "1", 0, None, None)]), path)
    assert ids(sources.read_or_empty(spark, path, schemas.SILVER)) == ["a"]


def test_path_view(spark, tmp_path):
    path = str(tmp_path / "flat")
    sources.write_flat(silver_rows(spark, [("a", "1", 0, None, None)]), path)
    assert ids(sources.path_view(spark, "v_alerts", path)) == ["a"]
    assert spark.sql("SELECT count(*) AS n FROM v_alerts").first()["n"] == 1


def test_preview_is_ordered(spark):
    df = spark.range(100).select((F.lit(100) - F.col("id")).alias("n"))
    assert [r["n"] for r in sources.preview(df, ["n"], 3).collect()] == [1, 2, 3]
    assert "TakeOrderedAndProject" in plan_of(sources.preview(df, ["n"], 3))
