from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.sequence import with_previous
from cardwarden.operators.skew import SkewPolicy, hot_keys
from conftest import plan_of

SCHEMA = "k string, t long, id string, v double"


def expected(rows):
    """Brute force: the row before, per key, by (t, id); without a key there is none."""
    out = {r[2]: (None, None) for r in rows if r[0] is None}
    for key in {r[0] for r in rows} - {None}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for before, row in zip([None, *mine], mine, strict=False):
            out[row[2]] = (before[2], before[3]) if before else (None, None)
    return out


def result(df, policy):
    stepped = with_previous(
        df, "k", ["t", "id"], {"prev_id": F.col("id"), "prev_v": F.col("v")}, policy
    )
    rows = stepped.collect()
    assert len(rows) == len({r["id"] for r in rows})
    return {r["id"]: (r["prev_id"], r["prev_v"]) for r in rows}


def skewed_rows(n=3000):
    """A key with a third of all rows, a NULL key, and heavy ties."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 7 == 0 else f"c{rng.randrange(300)}"
        value = None if i % 11 == 0 else float(i)
        rows.append((key, rng.randrange(n // 4), f"{i:06d}", value))
    rng.shuffle(rows)
    return rows


def test_plain_way(spark):
    rows = skewed_rows()
    assert result(spark.createDataFrame(rows, SCHEMA), SkewPolicy()) == expected(rows)


@pytest.mark.parametrize("partitions", [1, 16])
def test_way_of_large_keys_gives_the_same_rows(spark, all_hot, partitions):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(df, all_hot) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_only_the_hot_key_leaves_the_plain_way(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    policy = SkewPolicy(hot_rows=500, sample_fraction=1.0)
    assert [r[0] for r in hot_keys(df, "k", policy).collect()] == ["hot"]
    assert result(df, policy) == expected(rows)


def test_one_instant_can_be_cut(spark, all_hot):
    """All rows of the key at one time: slices cut by the tie-break."""
    rows = [("hot", 7, f"{i:05d}", float(i)) for i in range(1000)]
    assert result(spark.createDataFrame(rows, SCHEMA), all_hot) == expected(rows)


def test_hot_keys_have_no_limit_and_need_no_size(spark, tmp_path):
    """A small compressed file may hold a large key."""
    spark.createDataFrame(skewed_rows(), SCHEMA).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    policy = SkewPolicy(hot_rows=2, sample_fraction=1.0)
    want = df.filter("k IS NOT NULL").groupBy("k").count().filter("count >= 2").count()
    assert hot_keys(df.filter("k IS NOT NULL"), "k", policy).count() == want > 5
    assert result(df, policy) == expected(skewed_rows())


def test_a_hot_key_must_be_seen_twice():
    with pytest.raises(ValueError, match="at least 2"):
        SkewPolicy(hot_rows=100, sample_fraction=0.01)


def test_one_shuffle_and_one_sort(spark):
    df = spark.createDataFrame(skewed_rows(30), SCHEMA)
    plan = plan_of(
        with_previous(df, "k", ["t", "id"], {"a": F.col("id"), "b": F.col("v"), "c": F.col("t")})
    )
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1
