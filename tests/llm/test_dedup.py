"""Jaccard join, suffix-array deduplication and components, against brute force."""

from __future__ import annotations

import random
import re

import pytest

from cardwarden.llm import jaccard, repeats
from cardwarden.llm.components import components
from conftest import plan_of
from llm.conftest import prose


def groups_of(nodes, links):
    label = {x: x for x in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            least = min(label[a], label[b])
            moved |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return label


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    low = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if len(low) < 5:
        return {tuple(low)} if low else set()
    return {tuple(low[i : i + 5]) for i in range(len(low) - 4)}


def near_copies(seed=1, families=4, size=12, length=60):
    """Families of texts with a few changed words, some right at the threshold."""
    rnd = random.Random(seed)
    rows, doc = [], 0
    for family in range(families):
        base = prose(family, length).split()
        for _ in range(size):
            words = list(base)
            for _ in range(rnd.randint(0, 2)):
                words[rnd.randrange(length)] = f"n{doc}y{rnd.randrange(99)}"
            rows.append((doc, " ".join(words)))
            doc += 1
    rnd.shuffle(rows)
    return rows


def test_components_of_chain_hub_and_pair(spark):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(100, i) for i in range(101, 160)]
    links = chain + hub + [(300, 200), (200, 300), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    want = groups_of({x for e in links for x in e}, links)
    assert found == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in groups_of(sets, links).items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_join_equals_brute_force(documents, seed):
    rows = near_copies(seed)
    rows += [(1000, ""), (1001, None), (1002, "a B"), (1003, "A b"), (1004, " \n"), (1005, "b a")]
    rows += [(2000, rows[0][1]), (1999, rows[0][1].upper()), (2001, prose(9, 3000)), (2002, prose(9, 3000) + " z")]
    found = jaccard.grouped(jaccard.join(documents(rows))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected_components(rows)


def test_join_of_unlinked_lookalikes_with_shared_passages(documents):
    """Texts that share most words and still lie under the threshold stay apart."""
    common = prose(5, 60)
    rows = [(i, f"{prose(100 + i, 12)} {common}") for i in range(40)]
    found = jaccard.grouped(jaccard.join(documents(rows))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected_components(rows)
    assert all(r.component_id == r.doc_id for r in found)


@pytest.mark.parametrize("seed", [1, 5])
def test_frequent_shingles_are_put_in_order_by_size(documents, monkeypatch, seed):
    """From two occurrences on a shingle counts as frequent, so most lists go that way."""
    monkeypatch.setattr(jaccard, "OFTEN", 2)
    monkeypatch.setattr(jaccard, "TIMES_MEAN", 0)
    rows = near_copies(seed, families=3) + [(1000, None), (1001, "a b"), (1002, "A B")]
    rows += [(2000 + i, prose(40, 60 + i)) for i in range(12)]
    found = jaccard.grouped(jaccard.join(documents(rows))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected_components(rows)


def test_lists_by_size_lose_no_pair(spark):
    """Rows of a token that can be similar share a chain, by rows and by sizes."""
    rnd = random.Random(8)
    rows = []
    for nid in range(400):
        n = rnd.choice([5, 9, 30, 31, 36, 45, 60, 200, 260])
        rows.append((rnd.randrange(9), nid, n, rnd.randrange(n // 5 + 1)))
    df = spark.createDataFrame(rows, "token long, nid long, n long, pos int")
    fits = lambda a, b: 4 * (a[2] + b[2]) <= 9 * min(a[2] - a[3], b[2] - b[3])
    for chained in (jaccard._shared(df), jaccard._shared_often(df)):
        token = {r.nid: r.token for r in chained.collect()}
        for a in rows:
            for b in rows:
                if a[1] < b[1] and a[0] == b[0] and 4 * max(a[2], b[2]) <= 5 * min(a[2], b[2]) and fits(a, b):
                    assert token[a[1]] == token[b[1]]
        assert len(token) <= len(rows)


def test_a_group_of_copies_makes_few_pairs(documents):
    rows = near_copies(7, families=1, size=80, length=80)
    found = jaccard.join(documents(rows))
    n = found.nodes.count()
    assert found.links.count() < 4 * n


def test_one_of_each_keeps_columns_and_empty_documents(documents):
    rows = near_copies(4, families=2, size=6) + [(90, ""), (91, None), (5, None), (None, "lone words of a row")]
    docs = documents(rows, "n f1 nid token c0 k1 t1 id")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    want = expected_components([r for r in rows if r[0] is not None and r[1]])
    ids = sorted({c for _, c in want.values()} | {90, 91}) + [5]
    found = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in found if x is not None) == sorted(ids) and found.count(None) == 1


def test_empty_tables(documents):
    docs = documents([])
    assert jaccard.grouped(jaccard.join(docs)).count() == 0
    assert repeats.find(docs).count() == 0
    assert repeats.remove(docs).count() == 0


def brute_spans(rows, length=repeats.LENGTH):
    seen, spans = {}, []
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    words = {r: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in order}
    for r in order:
        w = words[r]
        for i in range(len(w) - length + 1):
            seen.setdefault(tuple(w[i : i + length]), (r[0], i))
    for r in order:
        w, run = words[r], None
        for i in range(len(w) - length + 1):
            first = seen[tuple(w[i : i + length])]
            if first == (r[0], i):
                continue
            if run and i <= run[1]:
                run[1] = i + length
            else:
                if run:
                    spans.append((r[0], run[0], run[1] - run[0], *run[2]))
                run = [i, i + length, first]
        if run:
            spans.append((r[0], run[0], run[1] - run[0], *run[2]))
    return sorted(spans, key=str)


def passages(seed):
    rnd = random.Random(seed)
    shared = [prose(900 + i, rnd.choice([49, 50, 51, 75, 120])) for i in range(4)]
    rows = []
    for doc in range(30):
        parts = []
        for _ in range(rnd.randint(1, 3)):
            parts.append(prose(doc * 10 + rnd.randrange(10), rnd.randint(1, 60)))
            if rnd.random() < 0.6:
                parts.append(rnd.choice(shared))
        rows.append((doc, rnd.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(50, rows[3][1]), (51, rows[3][1]), (52, "la " * 130), (53, None), (54, ""), (55, prose(1, 50))]
    return rows


@pytest.mark.parametrize(("seed", "in_task"), [(1, 4096), (2, 4096), (1, 2), (3, 2)])
def test_spans_equal_brute_force(documents, monkeypatch, seed, in_task):
    monkeypatch.setattr(repeats, "IN_TASK", in_task)
    rows = passages(seed)
    found = repeats.find(documents(rows)).collect()
    have = sorted(((r.doc_id, r.start, r.n_words, r.first_doc_id, r.first_start) for r in found), key=str)
    assert have == brute_spans(rows)


def test_repeated_rows_and_null_ids_are_single_documents(documents):
    text = prose(3, 70)
    rows = [(None, text), (4, text), (4, text), (6, prose(6, 70)), (6, prose(6, 70))]
    found = repeats.find(documents(rows)).collect()
    assert [(r.doc_id, r.start, r.n_words, r.first_doc_id) for r in found] == [(4, 0, 70, None)]


def test_remove_cuts_later_occurrences_only(documents):
    shared = prose(8, 60)
    rows = [(1, f"a b\n{shared}  c"), (2, f"d {shared}\n\ne f"), (3, shared), (4, "short text"), (5, None)]
    docs = documents(rows, "start nid c1 at")
    cut = repeats.remove(docs)
    assert cut.columns == docs.columns
    found = {r.doc_id: r.text for r in cut.collect()}
    assert found == {1: rows[0][1], 2: "d e f", 4: "short text", 5: None}


def test_index_side_has_no_cartesian_product(documents):
    found = jaccard.grouped(jaccard.join(documents(near_copies(2))))
    assert "Cartesian" not in plan_of(found) and "NestedLoop" not in plan_of(found)
