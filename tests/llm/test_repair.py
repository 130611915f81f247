"""Conversation structure repair against a search of all edits in order of cost."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardwarden.llm import queries, repair

ROWS = "conv_id long, turn long, role string, text string"
NOTHING = hashlib.sha256(b"").hexdigest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def fault(row, seen):
    last = re.findall(r"[^\x20\x09-\x0D]", row[3])
    if not last:
        return "blank"
    if row[2:] in seen:
        return "duplicate"
    return None if last[-1] in ".!?" else "truncated"


def well_formed(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def could_be(initials):
    return any(well_formed(initials + rest) for rest in ("", "a", "ua"))


def cheapest(rows, faults):
    """The edits of least cost, then of least text, by trying all in that order."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, initials, lines = heapq.heappop(heap)
        if i == len(rows) and well_formed(initials):
            return cost, audit, "\n".join(lines)
        key = (i, initials[-1:] if len(initials) > 1 else initials, cost, audit)
        if key in done:
            continue
        done.add(key)
        tries = [("I", 2, i, r, f"{r}:") for r in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i][2:]
            tries.append(("D", 3, i + 1, "", None))
            if faults[i] not in ("blank", "duplicate"):
                cut = faults[i] == "truncated"
                tries.append(("K", cut, i + 1, role[:1] or "x", f"{role}:{text}"))
                tries += [("R", 2 + cut, i + 1, r, f"{r}:{text}") for r in ("user", "assistant")]
        for edit, more, j, role, line in tries:
            new = initials + role[:1]
            if cost + more <= 3 * len(rows) and could_be(new):
                kept = lines if line is None else (*lines, line)
                heapq.heappush(heap, (cost + more, audit + edit, j, new, kept))


def brute(rows, conversations):
    out = []
    for conv in {r[0] for r in conversations}:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults = [fault(r, [e[2:] for e in own[:i]]) for i, r in enumerate(own)]
        n = Counter(faults)
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:], strict=False)]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        cost, audit, text = cheapest(own, faults)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=str)


def digests(spark, rows, conversations=None, ready=False):
    df = spark.createDataFrame(rows, ROWS)
    every = df if conversations is None else spark.createDataFrame(conversations, ROWS)
    found = repair.digests(df if ready else repair.damage(df), every)
    return sorted((tuple(r) for r in found.collect()), key=str)


def some(seed, conversations, longest=6):
    rnd = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rnd.choice(["Yes.", "No!", "cut", " \n", "", None, f"Word {turn}.", "end.\x0b\t "])
            rows.append((conv, rnd.choice([turn, turn, turn * 2, None]), role, text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_all_edits_in_order_of_cost(spark, documents, seed):
    documents([])
    rows = some(seed, 120)
    assert digests(spark, rows) == brute(damaged(rows), rows)


def test_small_cases(spark, documents):
    documents([])
    nothing = (0, 0, 0, 0, 0, 0, "", NOTHING)
    rows = [
        (1, 0, "user", "Hi."),
        (1, 1, "assistant", "Ho."),
        (2, 0, "assistant", "Ho."),
        (3, 0, "system", "Be."),
        (4, 5, "user", "Hi."),
        (4, 9, "user", "Hi."),
        (None, None, None, None),
    ]
    found = {r[0]: r[1:] for r in digests(spark, rows, [*rows, (9, 0, "user", "x")], ready=True)}
    text = hashlib.sha256(b"user:Hi.\nassistant:Ho.").hexdigest()
    assert found[1] == (0, 0, 0, 0, 0, 0, "KK", text)
    assert found[2][5:7] == (2, "IK")
    assert found[3][5:7] == (3, "D")
    assert found[4] == (3, 0, 1, 0, 1, 5, "KDI", hashlib.sha256(b"user:Hi.\nassistant:").hexdigest())
    assert found[None] == (0, 1, 0, 0, 0, 3, "D", NOTHING)
    assert found[9] == nothing
    assert digests(spark, []) == []


def test_a_long_conversation_is_searched_in_pieces(spark, documents):
    """Pieces, slices and one search of the whole give the same edits."""
    documents([])
    rnd = random.Random(5)
    roles = ("system", "user", "assistant")
    rows = [(1, i, rnd.choice(roles), rnd.choice(["A.", "B", f"C{i}."])) for i in range(90)]
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        got = digests(spark, rows, ready=True)
        placed = repair._ordered(repair._faults(spark.createDataFrame(rows, ROWS)))
        assert placed.select("slice").distinct().count() > 1
    finally:
        spark.conf.unset(merge)
    own = sorted(rows, key=lambda r: r[1])
    faults, seen = [], []
    for r in own:
        faults.append(fault(r, seen))
        seen.append(r[2:])
    items = [
        (1, "", False) if f in ("blank", "duplicate") else (0, r[2][:1], f == "truncated")
        for r, f in zip(own, faults, strict=True)
    ]
    assert got[0][6:8] == repair.cheapest(items, 0, repair.ACCEPTED)


def test_many_copies_are_one_row_until_the_end(spark, documents):
    documents([])
    rows = [(1, 0, "user", "Hi.")] * 500 + [(1, 1, "assistant", "Ho.")]
    assert repair._faults(spark.createDataFrame(rows, ROWS)).count() == 2
    [found] = digests(spark, rows, ready=True)
    assert found[2:7] == (0, 499, 0, 499, 1497)
    assert found[7] == "K" + "D" * 499 + "K"


def test_repaired_rows(spark, documents):
    """The operator's own output: every row with its edit, and the rows put in."""
    documents([])
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "cut"), (2, 0, "system", "Be."), (2, 3, "tool", "x" * 100000)]
    df = spark.createDataFrame(rows, ROWS).withColumns({"slice": F.lit("s"), "n": F.lit(1), "edit": F.lit(0)})
    found = repair.repair(df).orderBy("conv_id", "slice", "step").collect()
    assert [(r.conv_id, r.edit, r.turn, r.role, r.fault) for r in found] == [
        (1, "K", 0, "user", 0),
        (1, "R", 1, "assistant", 3),
        (2, "K", 0, "system", 0),
        (2, "I", None, "user", 0),
        (2, "R", 3, "assistant", 3),
    ]
    assert [len(r.text) for r in found] == [3, 3, 3, 0, 100000]


def test_query(spark, documents):
    documents([])
    sf = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    found = queries.QUERIES["op13_repair_conversations"](spark, sf).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(damaged(table), table)
