"""Source mixing, against targets shared by hand and multipliers found by bisection."""

from __future__ import annotations

import math
import random

import pytest

from cardwarden.llm import mixing
from cardwarden.llm.queries import QUERIES


def words(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n))


def brute_targets(sizes):
    """Share by weight; what is above the cap is shared again among the others."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        base = sum(weight[s] for s in free)
        share = {s: rest * weight[s] / base for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in above}


def brute_rates(sizes, target):
    total, mean = sum(sizes), sum(sizes) / len(sizes)
    if target >= 3 * total:
        return [3.0] * len(sizes)
    low, high = -1e4, 1e4
    rate = lambda m, s: min(3.0, math.exp(min(m * s / mean, 2.0)))
    for _ in range(200):
        middle = (low + high) / 2
        if sum(s * rate(middle, s) for s in sizes) < target:
            low = middle
        else:
            high = middle
    return [rate(low, s) for s in sizes]


def corpus(seed=1):
    rnd = random.Random(seed)
    rows = []
    for source, n in (("b", 60), ("a", 25), ("é", 9), ("B", 3), (None, 14), ("zero", 2)):
        for _ in range(n):
            size = 0 if source == "zero" else rnd.choice([1, 3, 8, 8, 20, rnd.randint(0, 90)])
            rows.append((len(rows), words(size), "en", source))
    rows += [(500, None, "en", "a"), (501, "", None, "a")]
    return rows


def run(documents, rows):
    sized, sources, cells = mixing.mix(documents(rows, "_size _hash copies"))
    joined = sized.join(cells, mixing.CELL, "left").join(sources, mixing.SOURCE)
    return joined.select("*", mixing.copies().alias("copies")).collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_rates_and_copies(documents, seed):
    rows = corpus(seed)
    found = run(documents, rows)
    assert len(found) == len(rows)
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r[0])
    totals = {s: sum(size[i] for i in ids) for s, ids in by.items()}
    targets = brute_targets(totals)
    got = {r.doc_id: r for r in found}
    for source, ids in by.items():
        rates = brute_rates([size[i] for i in ids if size[i]] or [1], targets[source])
        rate = dict(zip([i for i in ids if size[i]], rates, strict=False))
        for i in ids:
            assert got[i]["_size"] == size[i] and got[i]["_words"] == totals[source]
            assert got[i]["_target"] == pytest.approx(targets[source])
            if size[i]:
                assert got[i]["_rate"] == pytest.approx(rate[i], rel=1e-5)
                assert 0 <= got[i]["copies"] <= 3
        taken = sum(got[i]["copies"] * size[i] for i in ids)
        assert abs(taken - targets[source]) <= max(2, 0.05 * targets[source])


def test_reruns_agree_and_a_large_cell_is_split_exactly(documents, monkeypatch):
    monkeypatch.setattr(mixing, "_IN_BUCKET", 8)
    rows = [(i, f"same {i % 7} words", "en", "x") for i in range(300)] + [(900, words(500), "en", "y")]
    first, second = (sorted((r.doc_id, r.copies) for r in run(documents, rows)) for _ in range(2))
    assert first == second
    target = brute_targets({"x": 900, "y": 500})["x"]
    assert abs(3 * sum(c for i, c in first if i < 900) - target) <= 3


def test_edges(documents):
    assert run(documents, []) == []
    assert [(r.copies, r["_target"]) for r in run(documents, [(1, None), (1, ""), (None, " ")])] == [(1, 0.0)] * 3
    docs = documents([(1, words(10), None, "a"), (1, words(10), None, "a"), (None, words(4), "en", None)], "c0 _copy _n")
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and 0 < mixed.count() <= 9
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_main_path_runs_no_python(spark):
    plan = QUERIES["op1_mix_sources"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
