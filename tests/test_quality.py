from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.operators import quality
from cardwarden.operators.quality import Rule
from conftest import plan_of
from frames import bronze_rows

NOW = datetime(2026, 4, 1)
MATRIX_SCHEMA = (
    "transaction_id string, customer_id string, points_earned long, status string,"
    " transaction_date timestamp"
)


def keys(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k string, n int")


@pytest.fixture
def matrix(spark):
    day = datetime(2026, 3, 31)
    return spark.createDataFrame(
        [
            ("good", "1", 5, "processed", day),
            ("warned", "1", -1, "pending", day),
            ("void", "1", 0, "void", day),
            ("old", "1", 0, "cancelled", datetime(2019, 12, 31)),
            ("future", "1", 0, "processed", datetime(2026, 4, 2)),
            ("nulls", "1", None, None, None),
            ("twice", "1", 0, "processed", day),
            ("twice", "2", 0, "processed", day),
            (None, None, 0, "processed", day),
        ],
        MATRIX_SCHEMA,
    )


def test_null_and_duplicate_checks(spark):
    df = keys(spark, ["a", "a", "a", None, None, "b"])
    assert quality.check_nulls(df, ["n", "k"]) == (False, "column k holds 2 NULL values")
    assert quality.check_nulls(df, ["n"])[0]
    # 2 surplus rows of "a" and 1 of NULL
    assert quality.check_duplicates(df, "k") == (False, "3 duplicate rows for key k")
    assert quality.check_duplicates(df, "n")[0]


def test_checks_pass_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, n int")
    assert quality.check_nulls(df, ["k"])[0]
    assert quality.check_duplicates(df, "k")[0]


def test_uniqueness_skips_nulls_and_fails_all_rows_of_a_key(spark, all_hot):
    df = keys(spark, ["a", "a", "a", None, None, "b", "c", "c"])
    for policy in ({}, {"policy": all_hot}):
        bad = quality.unique_violations(df, "k", **policy)
        assert bad.columns == df.columns
        assert sorted(r["n"] for r in bad.collect()) == [0, 1, 2, 6, 7]
    row = quality.evaluate(df, [Rule("U", "k", "unique")]).first()
    assert (row["evaluated"], row["failed"], row["success"]) == (6, 5, False)


def test_rule_matrix(matrix):
    rows = {r["rule_id"]: r for r in quality.evaluate(matrix, quality.MATRIX, NOW).collect()}
    assert {i: (r["evaluated"], r["failed"]) for i, r in rows.items()} == {
        "DQ-F01": (9, 1),
        "DQ-F02": (8, 2),
        "DQ-F03": (9, 1),
        "DQ-N01": (8, 1),
        "DQ-N02": (8, 1),
        "DQ-N03": (8, 2),
    }
    assert {i for i, r in rows.items() if r["severity"] == "warn"} == {"DQ-N01"}
    verdict = quality.suite_success(quality.evaluate(matrix, quality.MATRIX, NOW)).first()
    assert tuple(verdict) == (False, False)


def test_warning_does_not_stop(matrix):
    warned = matrix.filter("transaction_id IN ('good', 'warned')")
    results = quality.evaluate(warned, quality.MATRIX, NOW)
    assert tuple(quality.suite_success(results).first()) == (False, True)
    assert len(quality.gate(results, "bronze")) == 6


def test_gate_raises_with_results(matrix):
    with pytest.raises(quality.QualityGateError, match="DQ-N02 on status: 1 of 8") as error:
        quality.gate(quality.evaluate(matrix, quality.MATRIX, NOW), "bronze")
    assert len(error.value.results) == 6


def test_quarantine_and_accepted_split_the_input(matrix, all_hot):
    for policy in ({}, {"policy": all_hot}):
        held = quality.quarantine(matrix, quality.MATRIX, NOW, **policy)
        reasons = sorted((r["transaction_id"] or "", r["failed_rules"]) for r in held.collect())
        assert reasons == [
            ("", ["DQ-F01", "DQ-F03"]),
            ("future", ["DQ-N03"]),
            ("old", ["DQ-N03"]),
            ("twice", ["DQ-F02"]),
            ("twice", ["DQ-F02"]),
            ("void", ["DQ-N02"]),
        ]
        kept = quality.accepted(matrix, quality.MATRIX, NOW, **policy)
        assert sorted(r["transaction_id"] for r in kept.collect()) == ["good", "nulls", "warned"]
        assert kept.columns == matrix.columns


def test_default_upper_date_is_now(spark):
    df = spark.createDataFrame([(datetime(2999, 1, 1),)], "transaction_date timestamp")
    assert quality.evaluate(df, [quality.MATRIX[-1]]).first()["failed"] == 1


def test_row_rules_share_one_aggregate(matrix):
    row_rules = [r for r in quality.MATRIX if r.kind != "unique"]
    plan = plan_of(quality.evaluate(matrix, row_rules, NOW))
    assert plan.count("Exchange") == 1


def test_unknown_kind_is_refused(matrix):
    with pytest.raises(ValueError, match="unknown rule kind"):
        quality.evaluate(matrix, [Rule("X", "status", "no_such_kind")])


def test_schema_check(spark):
    df = bronze_rows(spark, [(None, "1", "x", "1")]).drop("ip_address").withColumns(
        {"device_id": F.lit(1), "extra": F.lit(1.0)}
    )
    out = quality.schema_check(df, schemas.BRONZE, ["tx_id", "cust_id"])
    status = {r["column_name"]: (r["status"], r["null_count"]) for r in out.collect()}
    assert status["tx_id"] == ("null_values", 1)
    assert status["cust_id"] == ("ok", 0)
    assert status["ip_address"] == ("missing", None)
    assert status["device_id"] == ("wrong_type", None)
    assert status["extra"] == ("unexpected", None)
    assert status["channel"] == ("ok", None)


def test_orphans(spark):
    children = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "id string, parent int")
    parents = spark.createDataFrame([(1,), (None,)], "key int")
    out = quality.orphans(children, "parent", parents, "key")
    assert [r["id"] for r in out.collect()] == ["b"]
