"""Exact top-k search over bit slices, against all inner products."""

from __future__ import annotations

import math
import random

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import bitsliced, queries

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, k=5):
    def ints(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * float(np.float32(x))) for x in v]

    usable = [(i, vec, ints(v)) for i, (vec, v, *_) in enumerate(rows) if ints(v) is not None]
    out = []
    for i, vec, q in usable:
        if vec is None or vec % every:
            continue
        found = [
            (-sum(a * b for a, b in zip(q, v, strict=True)), other is None, other or 0, other)
            for j, other, v in usable
            if j != i and len(v) == len(q)
        ]
        found.sort(key=lambda x: x[:3])
        out += [(vec, n + 1, x[3], -x[0]) for n, x in enumerate(found[:k])]
    return sorted(out, key=str)


@pytest.fixture
def found(spark, documents):
    documents([])

    def run(rows, every=50, k=5):
        df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("rid", "part", "v")})
        vectors = bitsliced.quantised(df)
        asked = vectors.where(F.col("vec_id") % every == 0)
        return sorted((tuple(r) for r in bitsliced.search(vectors, asked, k).collect()), key=str)

    return run


@pytest.mark.parametrize("block", [64, 200, 8192])
def test_against_all_products(found, monkeypatch, block):
    monkeypatch.setattr(bitsliced, "BLOCK", block)
    rnd = np.random.default_rng(block)
    rows = [(i, (rnd.standard_normal(16) / 4).tolist(), 0) for i in range(600)]
    assert found(rows, 20) == brute(rows, 20)


def test_ties_repeats_and_rows_that_take_no_part(found):
    rnd = random.Random(3)
    same = [0.5, -0.25, 0.125]
    rows = [(i, same, None) for i in range(0, 400, 7)]
    rows += [(i, [rnd.uniform(-1, 1) for _ in range(3)], 1) for i in range(400, 700)]
    rows += [(50, same, 1), (50, same, 1), (None, same, 1), (100, [0.0, 0.0, 0.0], 1)]
    rows += [(150, None, 1), (200, [], 1), (250, [1.0, None, 1.0], 1), (300, [1.0, float("nan"), 0.0], 1)]
    rows += [(1, [float("inf"), 0.0, 0.0], 1), (450, [1.0, 2.0], 1), (451, [1.0, -2.0], 1), (500, [7.0], 1)]
    assert found(rows) == brute(rows)


def test_wide_values_and_constant_components(found):
    rnd = random.Random(4)
    rows = [(i, [rnd.uniform(-1e6, 1e6), 3.0, rnd.choice([0.0, 1e-9, -1e-9])], 1) for i in range(300)]
    assert found(rows, 10) == brute(rows, 10)
    rows.append((1000, [1e30, 0.0, 0.0], 1))  # no inner product of it need fit in 64 bits
    assert found(rows, 10) == brute(rows[:-1], 10)


def test_few_and_none(found):
    assert found([]) == []
    assert found([(0, [1.0], 1)]) == []
    assert found([(0, [1.0], 1), (1, [-1.0], 1)]) == [(0, 1, 1, -65536)]


def test_query(spark, documents):
    documents([])
    sf = "/root/testdata/sf0.001"
    df = queries.QUERIES["op12_top_k_bit_sliced"](spark, sf)
    assert oracle.difference(df, oracle.connect(sf), queries.ORACLE["op12_top_k_bit_sliced"]) is None
