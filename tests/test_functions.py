from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwarden.functions import (
    haversine_km,
    parse_amount,
    parse_timestamp,
    sentinel_to_null,
    source_or_null,
    speed_kmh,
)
from conftest import plan_of


def test_amount_text(spark):
    texts = ["12,5", "85.0", "1.234,56", "abc", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_amount(F.col("t"))).collect()]
    assert got == [12.5, 85.0, None, None, None, None]


def test_timestamp_text(spark):
    df = spark.createDataFrame([("2026-03-31 11:35:02",), ("31/03/2026",), (None,)], "t string")
    parsed = df.select(parse_timestamp(F.col("t")).cast("string"))
    assert [r[0] for r in parsed.collect()] == ["2026-03-31 11:35:02", None, None]
    other = df.select(parse_timestamp(F.col("t"), "dd/MM/yyyy").cast("string"))
    assert [r[0] for r in other.collect()] == [None, "2026-03-31 00:00:00", None]


def test_sentinel(spark):
    df = spark.createDataFrame([("N/A",), ("Aveiro",), (None,)], "t string")
    got = [r[0] for r in df.select(sentinel_to_null(F.col("t"))).collect()]
    assert got == [None, "Aveiro", None]


def test_missing_source_column_is_typed_null(spark):
    df = spark.createDataFrame([("1.5",)], "latitude string")
    out = df.select(source_or_null(df, "latitude"), source_or_null(df, "longitude"))
    assert out.dtypes == [("latitude", "double"), ("longitude", "double")]
    assert tuple(out.first()) == (1.5, None)


def distances(spark, points):
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    columns = [F.col(c) for c in "abcd"]
    return [r[0] for r in df.select(haversine_km(*columns)).collect()]


@pytest.mark.parametrize(
    ("points", "expected"),
    [
        ((0.0, 0.0, 0.0, 1.0), 111.19492664455873),
        ((0.0, 0.0, 0.0, 180.0), 20015.0868),
        ((38.7, -9.1, 38.7, -9.1), 0.0),
        ((None, 0.0, 0.0, 1.0), 0.0),
        ((0.0, 0.0, 0.0, None), 0.0),
    ],
)
def test_distance(spark, points, expected):
    assert distances(spark, [points])[0] == pytest.approx(expected, abs=1e-4)


latitude = st.floats(-90, 90)
longitude = st.floats(-180, 180)


@settings(
    max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(latitude, longitude, latitude, longitude), min_size=50, max_size=200))
def test_distance_is_symmetric_and_bounded(spark, points):
    forth = distances(spark, points)
    back = distances(spark, [(c, d, a, b) for a, b, c, d in points])
    for one, other in zip(forth, back, strict=True):
        assert 0.0 <= one <= math.pi * 6371.0 + 1e-6
        assert one == pytest.approx(other, abs=1e-3)


def test_speed(spark):
    df = spark.createDataFrame(
        [(100.0, 3600), (100.0, -1800), (5.0, 0), (5.0, None)], "km double, s long"
    )
    got = [r[0] for r in df.select(speed_kmh(F.col("km"), F.col("s"))).collect()]
    assert got == [100.0, 200.0, None, None]


def test_distance_needs_no_python_worker(spark):
    df = spark.range(5).select(*[F.col("id").cast("double").alias(c) for c in "abcd"])
    plan = plan_of(df.select(haversine_km(*[F.col(c) for c in "abcd"])))
    assert "Python" not in plan
