"""Conversation structure repair: the cheapest edits that give a well-formed conversation.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``. Rows are kept,
given another role, deleted, and empty rows inserted, each at its cost. The edits are
found by iterative-deepening A*: a depth-first search tries the edits in ASCII order of
their initials under a bound on the cost, remembers the states from which a remaining
budget has failed, and is repeated with the next higher bound; the first accepting path
is then the cheapest, and of the cheapest ones the ASCII-least.

A long conversation is searched in pieces. Between two pieces only the state of the
pattern counts, so each piece is searched from every state it may begin in to every state
it may end in, and the answers are joined up: costs add, and no answer of a piece is the
beginning of another one, so the least text of the whole is made of least texts of the
pieces. Rows are dealt out by range of (conversation, turn, role, text), so the pieces of
one conversation are searched by many tasks, whatever its length. Only what is sequential
by definition, the digest of a whole conversation, streams through one task.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.session import stored

# The rules' costs, and the faults of a row.
DELETE, INSERT, REROLE, CUT_SHORT = 3, 2, 2, 1
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: The pattern's states: at the start, after s, after u, after a. It accepts at 0 and 3.
ACCEPTED = -1
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_LETTER = {1: "s", 2: "u", 3: "a"}
_PAIRS = ("su", "ua", "au")
_LEADS_TO = {
    0: (ACCEPTED, 0, 1, 2, 3),
    1: (ACCEPTED, 1, 2, 3),
    2: (ACCEPTED, 2, 3),
    3: (ACCEPTED, 2, 3),
}
_WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
#: Rows of one search.
PIECE = 16
#: Characters of a text that the range of a task is cut by.
_HEAD = 64

_SPACES = " \t\n\x0b\f\r"


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by the crc32 of ``conv_id:turn``, mod 20.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row and
    4 sets the role user. A null counts as one space, in the key, the role and the text.
    """

    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.translate("text", ".!?", "")
    )
    return (
        rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"))
        .withColumn("kind", kind)
        .where(F.col("kind") != 0)
        .withColumn("text", F.coalesce(text, F.col("text")))
        .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
        .withColumn("_again", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
        .drop("kind", "_again")
    )


def _faults(rows: DataFrame) -> DataFrame:
    """Each distinct row with its number of copies and the fault of the first one.

    Equal rows follow each other, so copies are counted before anything is sorted: a row
    repeated without end is one row here.
    """
    said = ["conv_id", "turn", "role", "text"]
    once = rows.groupBy(*said).agg(F.count(F.lit(1)).alias("n"))
    once = once.withColumns(
        {"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "text", "role")}
    )
    once = stored(once, "rows")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = once.groupBy("conv_id", "h1", "h2").agg(
        F.min(turn).alias("first"), F.count(F.lit(1)).alias("times")
    )
    first = first.where(F.col("times") > 1).select(
        F.col("conv_id").alias("c"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first"
    )
    same = (
        once["conv_id"].eqNullSafe(first["c"])
        & (once["h1"] == first["g1"])
        & (once["h2"] == first["g2"])
    )
    ends = F.right(F.rtrim("text", F.lit(_SPACES)), F.lit(1))
    fault = (
        F.when(F.trim("text", F.lit(_SPACES)) == "", BLANK)
        .when(F.col("first").isNotNull() & (turn != F.col("first")), DUPLICATE)
        .when(~ends.isin(".", "!", "?"), TRUNCATED)
        .otherwise(NONE)
    )
    return once.join(first, same, "left").select(*said, "n", fault.alias("fault"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their slice and place in a global order by conversation, turn, role, text."""
    first = F.asc_nulls_first
    ranges = [first("conv_id"), first("turn"), "role", F.substring("text", 1, _HEAD)]
    order = [first("conv_id"), first("turn"), "role", "text"]
    placed = rows.repartitionByRange(*ranges).sortWithinPartitions(*order)
    return stored(
        placed.select(
            "*",
            F.spark_partition_id().alias("slice"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "ordered",
    )


Item = tuple[int, str, bool]  # rows that must go, or 0 and a row's initial and whether it is cut short


def cheapest(items: list[Item], start: int, goal: int) -> tuple[int, str] | None:
    """Cost and initials of the cheapest edits from one state to another, or None.

    With the goal ``ACCEPTED`` rows may also be inserted after the last one. Otherwise the
    last edit is that of the last row.
    """
    n = len(items)
    # What is surely still to pay from a row on. Each pair of neighbours that the pattern
    # does not allow, the end being one, costs one at least: an insertion mends one such
    # pair for 2, another role two for 2, and a deletion two for 3.
    ends = {ACCEPTED: ("a", "")}.get(goal, (_LETTER.get(goal, ""),))
    least, following = [0] * (n + 1), [None] * (n + 1)
    for i in range(n - 1, -1, -1):
        gone, initial, short = items[i]
        if gone:
            least[i], following[i] = least[i + 1] + DELETE * gone, following[i + 1]
            continue
        after = following[i + 1]
        fits = initial in ends if after is None else initial + after in _PAIRS
        least[i], following[i] = least[i + 1] + CUT_SHORT * short + (not fits), initial

    def still(i: int, q: int) -> int:
        if following[i] is None:
            fits = q in (0, 3) if goal == ACCEPTED else q == goal
            return least[i] + (0 if fits else INSERT)
        return least[i] + ((q, following[i]) not in _STEP)

    most = sum(DELETE * max(gone, 1) for gone, _, _ in items) + 2 * INSERT
    if goal == ACCEPTED:
        most += INSERT
    bound = still(0, start)
    while bound <= most:
        failed: dict[tuple[int, int], int] = {}
        beyond = math.inf
        path: list[str] = []

        def reach(i: int, q: int, left: int) -> bool:
            nonlocal beyond
            if goal not in _LEADS_TO[q]:
                return False
            need = still(i, q)
            if need > left:
                beyond = min(beyond, bound - left + need)
                return False
            if i == n and (q in (0, 3) if goal == ACCEPTED else q == goal):
                return True
            if failed.get((i, q), -1) >= left:
                return False
            gone, initial, short = items[i] if i < n else (0, "", False)
            tries = []
            if i < n:
                tries.append(("D" * max(gone, 1), i + 1, q, DELETE * max(gone, 1)))
            if i < n or goal == ACCEPTED:
                tries.append(("I", i, _WANTED[q][1], INSERT))
            if i < n and not gone:
                cut = CUT_SHORT * short
                if (q, initial) in _STEP:
                    tries.append(("K", i + 1, _STEP[q, initial], cut))
                tries.append(("R", i + 1, _WANTED[q][1], REROLE + cut))
            for edit, j, r, cost in tries:
                path.append(edit)
                if reach(j, r, left - cost):
                    return True
                path.pop()
            failed[i, q] = left
            return False

        if reach(0, start, bound):
            return bound, "".join(path)
        if beyond == math.inf:
            return None
        bound = beyond
    return None


class _Search:
    """The answers for one slice of one conversation, piece by piece."""

    def __init__(self, first: bool, last: bool):
        self.last = last
        self.base = {q: [] for q in ((0,) if first else range(4))}
        self.open = {q: {q: (0, "")} for q in self.base}
        self.items: list[Item] = []

    def add(self, n: int, fault: int, initial: str) -> None:
        must = n if fault in (BLANK, DUPLICATE) else n - 1
        if fault not in (BLANK, DUPLICATE):
            if len(self.items) >= PIECE:
                self._close(range(4))
            self.items.append((0, initial, fault == TRUNCATED))
        if must:
            if self.items and self.items[-1][0]:
                self.items[-1] = (self.items[-1][0] + must, "", False)
            else:
                self.items.append((must, "", False))

    def _close(self, goals) -> None:
        known: dict[tuple[int, int], tuple[int, str] | None] = {}
        for entry, states in self.open.items():
            found: dict[int, tuple[int, str]] = {}
            for (q, (cost, text)), goal in itertools.product(states.items(), goals):
                if (q, goal) not in known:
                    known[q, goal] = cheapest(self.items, q, goal)
                if known[q, goal] is not None:
                    more, edits = known[q, goal]
                    answer = (cost + more, text + edits)
                    found[goal] = min(found.get(goal, answer), answer)
            # What all answers begin with is settled.
            shared = os.path.commonprefix([text for _, text in found.values()])
            self.base[entry].append(shared)
            self.open[entry] = {q: (c, t[len(shared) :]) for q, (c, t) in found.items()}
        self.items = []

    def answers(self) -> Iterator[tuple[int, int, int, str]]:
        self._close((ACCEPTED,) if self.last else range(4))
        for entry, states in self.open.items():
            for goal, (cost, text) in states.items():
                yield entry, goal, cost, "".join(self.base[entry]) + text


def _searched(ordered: DataFrame) -> DataFrame:
    """Of each conversation's slice: where it begins, where it ends, at what cost and how."""
    spans = ordered.groupBy("conv_id").agg(F.min("slice").alias("lo"), F.max("slice").alias("hi"))
    spans = spans.where(F.col("lo") < F.col("hi")).withColumnRenamed("conv_id", "c")
    thin = ordered.select(
        "conv_id", "slice", "place", "n", "fault", F.left("role", F.lit(1)).alias("initial")
    ).join(spans, ordered["conv_id"].eqNullSafe(spans["c"]), "left")
    thin = thin.select(
        "conv_id",
        "slice",
        "place",
        "n",
        "fault",
        "initial",
        F.coalesce(F.col("slice") == F.col("lo"), F.lit(True)).alias("first"),
        F.coalesce(F.col("slice") == F.col("hi"), F.lit(True)).alias("last"),
    )
    kind = ordered.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, slice int, whole boolean, entry int, goal int, cost long, audit string"
    shape = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, search, rows = None, None, []

        def finished() -> None:
            for answer in search.answers():
                rows.append((*at[:3], *answer))

        for batch in batches:
            for conv, part, _, n, fault, initial, first, last in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if at is None or (conv, part) != at[:2]:
                    if at is not None:
                        finished()
                    at, search = (conv, part, first and last), _Search(first, last)
                search.add(n, fault, initial)
            if rows:
                yield _batch(rows, shape)
                rows = []
        if at is not None:
            finished()
            yield _batch(rows, shape)

    dealt = thin.repartition("conv_id", "slice").sortWithinPartitions("conv_id", "slice", "place")
    return stored(dealt.mapInArrow(run, schema), "searched")


def _batch(rows: list[tuple], shape: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(shape)
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _joined(searched: DataFrame) -> DataFrame:
    """The audit and the entry state of each slice, once its neighbours are known."""
    kind = searched.schema["conv_id"].dataType.simpleString()

    def along(parts: pd.DataFrame) -> pd.DataFrame:
        best = {0: (0, "", [])}
        for part, answers in sorted(parts.groupby("slice"), key=lambda x: x[0]):
            found: dict = {}
            for entry, goal, cost, audit in answers[["entry", "goal", "cost", "audit"]].itertuples(
                index=False
            ):
                if entry in best:
                    before, text, steps = best[entry]
                    answer = (before + cost, text + audit, [*steps, (part, entry, audit)])
                    found[goal] = min(found.get(goal, answer), answer)
            best = found
        rows = best[ACCEPTED][2]
        conv = [parts["conv_id"].iloc[0]] * len(rows)
        table = pd.DataFrame(rows, columns=["slice", "entry", "audit"])
        table.insert(0, "conv_id", pd.Series(conv, dtype=parts["conv_id"].dtype))
        return table

    # At most two conversations of a slice reach beyond it.
    open_ones = searched.where(~F.col("whole")).groupBy("conv_id")
    joined = open_ones.applyInPandas(along, f"conv_id {kind}, slice int, entry int, audit string")
    whole = searched.where("whole").select("conv_id", "slice", "entry", "audit")
    return whole.unionByName(joined)


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows in order, and before each slice of a conversation a row with its audit."""
    said = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")}
    rows = rows.select("conv_id", "turn", *(c.alias(n) for n, c in said.items()))
    ordered = _ordered(_faults(rows))
    audits = _joined(_searched(ordered)).withColumn("place", F.lit(-1).cast("long"))
    listed = ordered.withColumns({"entry": F.lit(None).cast("int"), "audit": F.lit(None).cast("string")})
    names = ["conv_id", "slice", "place", "entry", "audit", "turn", "role", "text", "n", "fault"]
    return listed.select(*names).unionByName(audits, allowMissingColumns=True).select(*names)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of each conversation's rows in order, and of the rows put in between, what is done.

    Yields (conversation, slice, edit, turn, old role, new role, text, fault); an inserted row has
    no old role. A row's copies are rows of their own.
    """
    audit, at, state, ends = "", 0, 0, 0
    for batch in batches:
        for conv, part, place, entry, edits, turn, role, text, n, fault in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            if place < 0:
                audit, at, state = edits, 0, entry
                ends = len(audit.rstrip("I"))  # after the last row's edit
                continue
            for copy in range(n):
                if copy and fault != BLANK:
                    fault = DUPLICATE
                while audit[at] == "I":
                    wanted, state = _WANTED[state]
                    yield conv, part, "I", None, None, wanted, "", NONE
                    at += 1
                edit, given = audit[at], role
                at += 1
                if edit == "K":
                    state = _STEP[state, role[:1]]
                elif edit == "R":
                    given, state = _WANTED[state]
                yield conv, part, edit, turn, role, given, text, fault
                if at >= ends:
                    for _ in range(len(audit) - at):
                        wanted, state = _WANTED[state]
                        yield conv, part, "I", None, None, wanted, "", NONE
                    at = len(audit)


def repair(rows: DataFrame) -> DataFrame:
    """Every row of the conversations with its edit, and the inserted rows, in order.

    ``rows`` has conv_id, turn, role and text; other columns are left out. Returns conv_id,
    slice, step (order within conv_id and slice), edit (K, R, D, I), turn, role (the new
    one), text and fault (0 none, 1 blank, 2 duplicate, 3 truncated). Rows of a
    conversation are taken by turn, null first; rows of one turn by role and text, in
    byte order. A null role or text is one space; rows with a null conv_id are one
    conversation. An empty table gives an empty one.
    """
    ready = _prepared(rows)
    kinds = {c: ready.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = (
        f"conv_id {kinds['conv_id']}, slice int, step long, edit string, turn {kinds['turn']}, "
        "role string, text string, fault int"
    )
    shape = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for step, (conv, part, edit, turn, _, role, text, fault) in enumerate(_edits(batches)):
            found.append((conv, part, step, edit, turn, role, text, fault))
            if len(found) == 1000:
                yield _batch(found, shape)
                found = []
        if found:
            yield _batch(found, shape)

    dealt = ready.repartition("conv_id", "slice").sortWithinPartitions("conv_id", "slice", "place")
    return dealt.mapInArrow(run, schema)


class _Digest:
    """The figures of one conversation as its edits stream by."""

    def __init__(self, conv):
        self.conv, self.hash, self.some = conv, hashlib.sha256(), False
        self.faults, self.illegal, self.cost, self.edits = [0] * 4, 0, 0, []
        self.before, self.turns, self.low, self.high = None, 0, None, None

    def add(self, edit, turn, old, role, text, fault) -> None:
        self.edits.append(edit)
        if old is not None:
            self.faults[fault] += 1
            if self.before is not None:
                self.illegal += self.before + old[:1] not in _PAIRS
            self.before = old[:1]
            if turn is not None and turn != self.high:
                self.turns, self.high = self.turns + 1, turn
                self.low = turn if self.low is None else self.low
        self.cost += {"K": 0, "I": INSERT, "R": REROLE, "D": DELETE}[edit]
        if edit != "D":
            self.cost += CUT_SHORT * (fault == TRUNCATED)
            line = f"{role}:{text}"
            self.hash.update(("\n" + line if self.some else line).encode("utf-8", "surrogatepass"))
            self.some = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        _, *faults = self.faults
        audit = "".join(self.edits)
        return (self.conv, gaps, *faults, self.illegal, self.cost, audit, self.hash.hexdigest())


def digests(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each of ``conversations`` (conv_id): faults, cost, audit, digest.

    Columns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256, of the repaired rows as ``role:text`` joined by newlines. A
    conversation without rows has zeros, an empty audit and the digest of nothing. A
    conversation's digest is sequential by definition, so its repaired rows stream
    through one task, which holds one batch of them and the audit.
    """
    ready = _prepared(rows)
    kind = ready.schema["conv_id"].dataType.simpleString()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string"
    shape = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, found = None, []
        for conv, _, *edit in _edits(batches):
            if one is None or conv != one.conv:
                if one is not None:
                    found.append(one.row())
                if len(found) == 1000:
                    yield _batch(found, shape)
                    found = []
                one = _Digest(conv)
            one.add(*edit)
        if one is not None:
            found.append(one.row())
            yield _batch(found, shape)

    order = [F.asc_nulls_first("conv_id"), "slice", "place"]
    found = ready.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, schema)
    every = conversations.select(F.col("conv_id").alias("c")).distinct()
    nothing = hashlib.sha256(b"").hexdigest()
    return every.join(found, every["c"].eqNullSafe(found["conv_id"]), "left").select(
        F.col("c").alias("conv_id"),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
