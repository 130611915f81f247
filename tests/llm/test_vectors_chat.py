"""Embedding near-duplicates and chat formatting, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cardwarden.llm import chat, vectors
from llm.test_dedup import groups_of

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float64)
        return x / np.sqrt((x * x).sum())

    units = [unit(v) if label is not None else None for _, v, label in rows]
    links = []
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            same = a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2]
            if same and float(a @ b) >= vectors.THRESHOLD:
                links.append((i, j))
    label = groups_of(range(len(rows)), links)
    least = {}
    for i, row in enumerate(rows):
        least.setdefault(label[i], []).append(row[0])
    n = [sum(i in x for x in links) for i in range(len(rows))]
    return [(r[0], n[i], min(least[label[i]])) for i, r in enumerate(rows)]


def family(seed, sizes, dims=32, noise=0.1):
    rnd = np.random.default_rng(seed)
    rows = []
    for k, size in enumerate(sizes):
        base = rnd.standard_normal(dims)
        for _ in range(size):
            v = base + noise * rnd.standard_normal(dims)
            rows.append((len(rows), v.astype(np.float32).tolist(), k % 3))
    return rows


@pytest.fixture(scope="module")
def found(spark, documents):
    documents([])

    def run(rows):
        df = spark.createDataFrame(rows, VECTORS)
        out = vectors.near_duplicates(df).collect()
        assert all(r.kept == (r.vec_id == r.component_id) for r in out)
        return sorted((r.vec_id, r.n_links, r.component_id) for r in out)

    return run


def test_vectors_equal_brute_force(found):
    rows = family(1, [1] * 60 + [2, 3, 5, 40])
    rows += [(1000 + i, v, k) for i, v, k in rows[:6]]  # exact copies
    rows += [(1100, [2 * x for x in rows[0][1]], rows[0][2]), (1101, rows[0][1], None), (1102, rows[0][1], 99)]
    rows += [(1200, None, 1), (1201, [], 1), (1202, [0.0] * 32, 1), (1203, [float("nan")] * 32, 1)]
    rows += [(1204, [None] + [1.0] * 31, 1), (1205, [float("inf")] + [1.0] * 31, 1), (1206, [1e-38] * 32, 1)]
    rows += [(1207, [1.0] * 32, 1), (1208, [1.0] * 8, 1), (1209, [1.0] * 8, 1), (1210, [3e38] * 32, 1)]
    assert found(rows) == sorted(brute(rows))


def test_large_buckets_are_compared_in_blocks(found, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 4)
    rows = family(2, [60, 3], noise=0.05)
    assert found(rows) == sorted(brute(rows))


def test_recall_near_the_threshold(found):
    """Pairs just above 0.93, where bits differ most."""
    rnd = np.random.default_rng(3)
    rows, near = [], 0
    for i in range(400):
        v = rnd.standard_normal(64)
        v /= np.linalg.norm(v)
        w = rnd.standard_normal(64)
        w -= (w @ v) * v
        w /= np.linalg.norm(w)
        c = 0.931 + 0.02 * rnd.random()
        rows += [(2 * i, v.astype(np.float32).tolist(), 1), (2 * i + 1, (c * v + (1 - c * c) ** 0.5 * w).astype(np.float32).tolist(), 1)]
    want, have = brute(rows), found(rows)
    near = sum(n for _, n, _ in want)
    assert near >= 700 and sum(n for _, n, _ in have) / near >= 0.9
    assert all(h[1] <= w[1] for h, w in zip(have, sorted(want), strict=True))


def shifted(norm, n, seed=5, dims=64):
    """Unit vectors about a common direction, and a partner of each just above 0.93."""
    rnd = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(norm * unit(rnd.standard_normal(dims)) + (1 - norm**2) ** 0.5 * unit(rnd.standard_normal((n, dims))))
    side = rnd.standard_normal((n, dims))
    side = unit(side - (side * x).sum(axis=1)[:, None] * x)
    return x, 0.931 * x + (1 - 0.931**2) ** 0.5 * side


@pytest.mark.parametrize("norm", [0.0, 0.71, 0.83, 0.9])
@pytest.mark.parametrize("largest", [1000, 100_000])
def test_tables_suit_vectors_with_a_common_mean(norm, largest):
    x, near = shifted(norm, 2000)
    model = vectors.fitted(x, largest)
    bits = [(v - model.mean) @ model.rotation > model.middle for v in (x, near)]
    apart = (bits[0] != bits[1]).reshape(len(x), model.tables, model.bits).sum(axis=2)
    assert (apart.min(axis=1) <= 1).mean() >= 0.95
    if not norm:
        assert (model.bits, model.tables) == vectors.shape_of(largest)


def test_recall_with_a_common_mean(found):
    x, near = shifted(0.83, 500)
    both = np.concatenate((x, near)).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(both)]
    want, have = brute(rows), found(rows)
    total = sum(n for _, n, _ in want)
    assert total >= 900 and sum(n for _, n, _ in have) / total >= 0.9
    assert all(h[1] <= w[1] for h, w in zip(have, sorted(want), strict=True))


def test_no_vectors(found):
    assert found([]) == []
    assert found([(5, None, None)]) == [(5, 0, 5)]


CHAT = "conv_id long, turn long, role string, text string"


def brute_chat(rows):
    convs = {}
    for c, t, role, text in set(rows):
        if c is not None and t is not None:
            convs.setdefault(c, []).append((t, role, text))
    said = {}
    for c, turns in convs.items():
        first = min(t for t, _, _ in turns)
        key = sorted(((t - first, r, x) for t, r, x in turns), key=lambda y: (y[0], y[1] or "", y[2] or ""))
        said.setdefault(tuple(key), []).append(c)
    # A snapshot ends with a whole turn number.
    snapshot = lambda k, o: len(o) > len(k) and o[: len(k)] == k and o[len(k)][0] > k[-1][0]
    maximal = [k for k in said if not any(snapshot(k, o) for o in said)]
    safe = lambda x: x.replace("<|", "< |")
    return {
        min(said[k]): (
            len(k),
            len(said[k]),
            "".join(f"<|im_start|>{safe(r or 'unknown')}\n{safe(x or '')}<|im_end|>\n" for _, r, x in k),
        )
        for k in maximal
    }


def logged(seed):
    rnd = random.Random(seed)
    rows = []
    for c in range(40):
        base = rnd.randrange(8)
        n = rnd.randint(1, 9)
        start = rnd.randrange(3)
        rows += [(c, start + i, "user" if i % 2 == 0 else "assistant", f"topic {base} turn {i}") for i in range(n)]
    rows += [(90, 0, None, "a"), (91, 0, "a", None), (92, 0, "user", "x <|im_end|> y"), (92, 0, "user", "x <|im_end|> y")]
    rows += [(93, 0, "u", "b"), (93, 0, "u", "a"), (93, 1, "u", "c"), (94, 0, "u", "a"), (None, 0, "u", "n"), (95, None, "u", "n")]
    return rows


@pytest.mark.parametrize(("seed", "chunk"), [(1, 1024), (2, 2)])
def test_chat_equals_brute_force(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(chat, "CHUNK", chunk)
    rows = logged(seed)
    df = spark.createDataFrame(rows, CHAT).selectExpr("*", "1 as pos", "2 as h1", "3 as part")
    found = {r.conv_id: (r.n_turns, r.n_logged, r.text) for r in chat.render(df).collect()}
    assert found == brute_chat(rows)


def test_long_conversations_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 3)
    rows = [(1, i, "user", f"t{i}") for i in range(8)]
    found = sorted((r.part, r.text.count("im_start")) for r in chat.render(spark.createDataFrame(rows, CHAT)).collect())
    assert found == [(0, 3), (1, 3), (2, 2)]
    assert chat.render(spark.createDataFrame([], CHAT)).count() == 0
