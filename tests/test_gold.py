from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import fraud, gold
from conftest import plan_of
from frames import ids, profile_rows, silver_rows

DAY = date(2026, 4, 1)


@pytest.fixture
def silver(spark):
    return silver_rows(
        spark,
        [
            ("a", "1", 0, None, None, 10.25, "Saúde"),
            ("b", "1", 1, None, None, 0.1, "Lazer"),
            ("c", "2", 2, None, None, 0.2, "Lazer"),
            ("d", None, 3, None, None, None, "Lazer"),
        ],
    )


def test_category_kpis(silver):
    for scale in (None, 4):
        out = gold.category_kpis(silver, DAY, exact_scale=scale)
        assert [tuple(r) for r in out.collect()] == [
            ("Saúde", 10.25, 1, DAY),
            ("Lazer", 0.3, 3, DAY),
        ]
        assert dict(out.dtypes)["total_revenue"] == "double"


def test_category_kpis_read_two_columns_and_preaggregate(spark, silver, tmp_path):
    silver.write.parquet(str(tmp_path / "s"))
    plan = plan_of(gold.category_kpis(spark.read.parquet(str(tmp_path / "s")), DAY))
    assert "partial_sum" in plan
    schema = "ReadSchema: struct<transaction_id:string,amount:double,category:string>"
    assert schema in plan


def test_totals(silver):
    kpis = gold.category_kpis(silver, DAY)
    assert tuple(gold.kpi_totals(kpis).first()) == (10.55, 4, 2.64)
    chosen = gold.kpis_for_categories(kpis, ["Lazer"])
    assert tuple(gold.kpi_totals(chosen).first()) == (0.3, 3, 0.1)
    assert gold.kpis_for_categories(kpis).count() == 2
    nothing = gold.kpis_for_categories(kpis, ["none"])
    assert tuple(gold.kpi_totals(nothing).first()) == (0.0, 0, 0.0)


def test_distinct_values(silver):
    kpis = gold.category_kpis(silver, DAY)
    assert ids(gold.distinct_categories(kpis), "category") == ["Lazer", "Saúde"]
    assert gold.active_customers(silver).first()[0] == 2
    assert gold.active_customers(silver, approximate=True).first()[0] == 2


def test_daily_change_needs_the_day_before(spark):
    days = [date(2026, 1, 1)] * 4 + [date(2026, 1, 2)] * 3 + [date(2026, 1, 4)]
    alerts = spark.createDataFrame([(d,) for d in days], "dt_particao date")
    got = {r["dt_particao"].day: tuple(r)[1:] for r in gold.alerts_daily_change(alerts).collect()}
    assert got == {1: (4, None, None), 2: (3, 4, -25.0), 4: (1, None, None)}
    assert gold.alert_count(alerts).first()["alert_count"] == 8


def test_enrichment_keeps_rows_without_profile(spark, silver):
    known = profile_rows(spark, [(1, "Gold", "Aveiro", ["p", "q"], [])])
    out = gold.enrich_with_profiles(silver, known)
    got = {r["transaction_id"]: (r["loyalty_tier"], r["active_products"]) for r in out.collect()}
    assert got == {
        "a": ("Gold", ["p", "q"]),
        "b": ("Gold", ["p", "q"]),
        "c": (None, None),
        "d": (None, None),
    }


def test_product_segments(spark):
    known = profile_rows(
        spark,
        [(1, "Gold", "A", ["p", "q"], []), (2, "Gold", "A", ["p"], []), (3, "Gold", "A", [], [])],
    )
    out = gold.product_segments(known)
    assert {r["product"]: r["customers"] for r in out.collect()} == {"p": 2, "q": 1}


def golden_sample(spark):
    """The shape of the documented sample: 102 rows, 19 customers, two times a day apart.

    Category sums and counts are the documented ones, spread over its rows.
    """
    totals = [
        ("Previdência", 28228.47, 25),
        ("Seguro", 27706.95, 20),
        ("Alimentação", 23377.15, 19),
        ("Saúde", 22218.81, 17),
        ("Lazer", 21640.77, 19),
        ("Eletrônicos", 9999.98, 2),
    ]
    rows = []
    for category, total, n in totals:
        each = round(total / n, 2)
        for i in range(n):
            amount = each if i else round(total - each * (n - 1), 2)
            j = len(rows)
            late = j >= 38 or j < 19
            rows.append((f"t{j:03d}", str(j % 19), 86400 if late else 0, None, None, amount, category))
    return silver_rows(spark, rows)


def test_golden_values(spark):
    silver = golden_sample(spark)
    kpis = gold.category_kpis(silver, DAY)
    assert [tuple(r)[:3] for r in kpis.collect()] == [
        ("Previdência", 28228.47, 25),
        ("Seguro", 27706.95, 20),
        ("Alimentação", 23377.15, 19),
        ("Saúde", 22218.81, 17),
        ("Lazer", 21640.77, 19),
        ("Eletrônicos", 9999.98, 2),
    ]
    assert tuple(gold.kpi_totals(kpis).first()) == (133172.13, 102, 1305.61)
    permissive = fraud.fraud_alerts(silver, "permissive")
    assert permissive.count() == 102 - 19
    assert permissive.filter(F.col("diff_seconds") == 86400).count() == 19
    assert fraud.fraud_alerts(silver, "strict").count() == 0
