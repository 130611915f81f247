"""Exact n-gram Jaccard join with set-relation skipping.

Documents are sets of word shingles. Equal sets are one node. Each node's shingles are
put in one global order, rare ones first, and only a prefix of them is indexed: two
sets at the threshold share a shingle in the first ninth of the smaller set and the
first fifth of the larger. From there two relations between sets save work, without
changing the answer:

* index lists are cut into blocks of equal set size and position; size and position
  bound the overlap, so whole pairs of blocks are skipped before any pair of sets is
  made, and so are blocks whose sets are already known to be connected;
* a set highly similar to a computed one (its pivot) derives its answers from the
  pivot's: the overlap of the pivots and the two differences bound the pair's overlap
  from both sides, and only pairs between the bounds are compared.

A group of thousands of near copies is linked by one comparison of each set with its
pivot, then by a few rounds of one comparison for each group that they have formed. Its
remaining pairs are never made; the pairs that are still open are then decided exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm import words as W
from cardwarden.llm.columns import apart, keyed, keys
from cardwarden.llm.components import components
from cardwarden.llm.tables import gathered
from cardwarden.session import discard, stored

#: Counters of the frequency sketch; it has this size for any input.
SKETCH = 1 << 22
#: Rounds in which each group is compared once with another before all open pairs are.
MERGES = 3
#: Pivots that a set is compared with at first, and pairs of a group in each round.
PIVOTS, TRIES = 1, 4
#: Bits of the filter that finds the texts of wanted sets; it has this size as well.
FILTER = 1 << 24
#: A shingle is frequent from this many occurrences by the sketch, and from this many times
#: the sketch's mean: its rows are put in order by size and not in one task.
OFTEN, TIMES_MEAN = 4096, 8
#: Bytes of text whose words are in memory at once.
SLICE_BYTES = 1 << 18
_SALT = W.randoms(2, 9)


def frequencies(docs: DataFrame) -> np.ndarray:
    """How many shingles of all documents fall to each of ``SKETCH`` counters.

    Only the order of shingles depends on it, never a result.
    """

    def count(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for w in W.slices(batch.column(0), lower=True, limit=SLICE_BYTES):
            _, value = W.shingles(w)
            np.add.at(total, (value & np.uint64(SKETCH - 1)).astype(np.int64), np.uint32(1))

    return gathered(docs.select("text"), count, SKETCH, np.uint32)


def _sorted_sets(w: W.Words, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles by text and order, their texts, and each text's number."""
    doc, value = W.shingles(w)
    if counts is None:
        order = np.lexsort((value, doc))
    else:
        order = np.lexsort((value, counts[(value & np.uint64(SKETCH - 1)).astype(np.int64)], doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return doc, value, np.bincount(doc, minlength=w.last - w.first)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(W.signed(values)))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive values, by 64-bit arithmetic; of none, 0."""
    out = np.zeros(len(sizes), np.uint64)
    some = sizes > 0
    if some.any():
        at = (np.cumsum(sizes) - sizes)[some]
        out[some] = np.add.reduceat(values, at)
    return out


def sets(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """Of each keyed document: n distinct shingles, set fingerprint f1 f2, prefix, rare.

    ``shared`` has the counters of ``frequencies``. The first ``rare`` shingles of the
    prefix are not frequent, those behind them are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = max(OFTEN, TIMES_MEAN * shared.value.mean())
        for batch in W.released(batches):
            for w in W.slices(batch.column(4), lower=True, limit=SLICE_BYTES):
                doc, value, n = _sorted_sets(w, shared.value)
                place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                probe = n - (4 * n + 4) // 5 + 1
                first = place < np.repeat(probe, n)
                columns = [x.slice(w.first, w.last - w.first) for x in batch.columns[:4]]
                columns.append(pa.array(n, pa.int64()))
                for salt in _SALT:
                    columns.append(pa.array(W.signed(_sums(W.mix(value + salt), n))))
                columns.append(_lists(value[first], np.where(n > 0, probe, 0)))
                counted = shared.value[(value[first] & np.uint64(SKETCH - 1)).astype(np.int64)]
                rare = np.bincount(doc[first][counted < often], minlength=len(n))
                columns.append(pa.array(rare, pa.int64()))
                names = ["doc_id", "k0", "k1", "k2", "n", "f1", "f2", "prefix", "rare"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, k0 long, k1 long, k2 long, n long, f1 long, f2 long"
    columns = docs.select("doc_id", "k0", "k1", "k2", "text")
    return columns.mapInArrow(run, f"{schema}, prefix array<long>, rare long")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows that another row of their token can be similar to, a token for each chain.

    A set of n shingles that has the token at ``pos`` is similar to no larger set than
    (5 n - 9 pos) / 4. In order of size a token's rows are cut wherever no earlier row
    reaches the next size: pairs across a cut cannot link. Each chain between cuts gets a
    token of its own and rows alone in theirs go. Rows stream by in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None  # one row, not yet decided
        linked, reach, begin = False, 0, 0  # of that row and its chain
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            token, _, n, pos = (c.to_numpy() for c in batch.columns)
            size = len(token)
            same = token[1:] == token[:-1]
            most = np.maximum((5 * n - 9 * pos) // 4, 0)
            if last is not None:
                most[0] = max(most[0], reach)
            # A running maximum that begins anew with each token.
            base = np.concatenate(([0], np.cumsum(~same))) << 40
            furthest = np.maximum.accumulate(base + most) - base
            link = np.concatenate(([linked], same & (furthest[:-1] >= n[1:])))
            opens = np.where(link, 0, np.arange(size))
            first = n[np.maximum.accumulate(opens)]
            if linked:
                first[np.cumsum(~link) == 0] = begin
            keep = link.copy()
            keep[:-1] |= link[1:]
            chain = W.mix(token.view(np.uint64) + W.mix(first.view(np.uint64)))
            columns = [pa.array(W.signed(chain)), *batch.columns[1:]]
            named = pa.RecordBatch.from_arrays(columns, names=["token", "nid", "n", "pos"])
            yield named.slice(0, size - 1).filter(pa.array(keep[:-1]))
            last = batch.slice(size - 1)
            linked, reach, begin = bool(link[-1]), int(furthest[-1]), int(first[-1])
            if linked:
                final = named.slice(size - 1)
        if linked:
            yield final

    ordered = rows.repartition("token").sortWithinPartitions("token", "n", "nid")
    return ordered.mapInArrow(run, rows.schema)


def _shared_often(rows: DataFrame) -> DataFrame:
    """The same for frequent tokens, whose rows may be a third of all.

    A token's rows of one size are counted as one before the shuffle, and sizes are put
    in order: a window holds no more rows than there are sizes. Rows then meet their size's
    chain in a join, which adaptive execution splits.
    """
    reach = F.expr("greatest((5 * n - 9 * pos) div 4, 0L)")
    sizes = rows.groupBy("token", "n").agg(F.max(reach).alias("most"), F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("token").orderBy("n")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.max("most").over(earlier), F.lit(0)))
    opens = F.when(F.col("before") < F.col("n"), F.col("n"))
    sizes = sizes.withColumn("first", F.last(opens, ignorenulls=True).over(order))
    in_chain = F.sum("rows").over(Window.partitionBy("token", "first"))
    sizes = sizes.withColumn("in_chain", in_chain).where(F.col("in_chain") > 1)
    linked = rows.join(sizes.select("token", "n", "before", "first"), ["token", "n"])
    # A row that reaches no other size and that none reaches is alone in its chain.
    linked = linked.where((F.col("before") >= F.col("n")) | (reach >= F.col("n")))
    return linked.select(F.xxhash64("token", "first").alias("token"), "nid", "n", "pos")


def _index(nodes: DataFrame) -> DataFrame:
    """token, nid, n and pos of all prefixes, as ``_shared`` leaves them."""
    listed = nodes.select("nid", "n", "rare", F.posexplode("prefix").alias("pos", "token"))
    columns = ["token", "nid", "n", "pos"]
    rare = listed.where(F.col("pos") < F.col("rare")).select(*columns)
    often = nodes.where(F.size("prefix") > F.col("rare")).select(
        "nid", "n", "rare", F.posexplode(F.expr("slice(prefix, int(rare) + 1, size(prefix))")).alias("pos", "token")
    )
    often = often.withColumn("pos", F.col("pos") + F.col("rare").cast("int"))
    often = stored(often.select(*columns), "often")
    found = stored(_shared(rare).union(_shared_often(often)), "index")
    discard(often)
    return found


def _least_overlap(a: Column, b: Column) -> Column:
    """The smallest overlap at which sets of these sizes have a Jaccard of 0.8."""
    return F.ceil(4 * (a + b) / 9)


def _similar_size(small: Column, large: Column) -> Column:
    return 5 * small >= 4 * large


@dataclass
class Links:
    """What the join finds.

    ``documents``: doc_id, k0, k1, k2, n, f1, f2 of every row. ``nodes``: nid, f1, f2, n, doc (the
    smallest id) of each distinct set. ``links``: a, b. ``groups``: node, component.
    """

    documents: DataFrame
    nodes: DataFrame
    links: DataFrame
    groups: DataFrame


def _overlaps(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with both sizes and the number of shingles that both have."""
    left = left.select(F.col("nid").alias("a"), F.col("shingles").alias("sa"))
    right = right.select(F.col("nid").alias("b"), F.col("shingles").alias("sb"))
    return _counted(pairs.join(right, "b").join(left, "a"))


def _counted(both: DataFrame) -> DataFrame:
    return both.select(
        "a",
        "b",
        F.size("sa").cast("long").alias("na"),
        F.size("sb").cast("long").alias("nb"),
        F.size(F.array_intersect("sa", "sb")).cast("long").alias("both"),
    )


def _with_pivots(pairs: DataFrame, nodes: DataFrame, named: DataFrame) -> DataFrame:
    """``_overlaps`` of sets with their pivots: each set is read for its pivot and sent there.

    A set has ``PIVOTS`` of them and so few rows; a pivot of very many sets has one.
    """
    own = pairs.select(F.col("a").alias("nid"), "a").distinct()
    members = _members(named, nodes, own.union(pairs.select("b", "a")))
    pivot = F.col("nid") == F.col("a")
    left = members.where(pivot).select("a", F.col("shingles").alias("sa"))
    right = members.where(~pivot).select("a", F.col("nid").alias("b"), F.col("shingles").alias("sb"))
    found = stored(_counted(right.join(left, "a")), "compared")
    discard(members)
    discard(pairs)
    return found


def _members(named: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Whole sets of the wanted nodes (nid and another column), from each node's first document.

    A bit filter of fixed size tells which texts may be wanted, so that sets and not
    all texts are shuffled, and only these texts go to Python; the join then decides.
    """
    key = ["k0", "k1", "k2"]
    needed = nodes.select("nid", *(f"rep.{k}" for k in key)).join(wanted, "nid")
    needed = stored(needed, "wanted")
    # A row holds 256 bits of the filter, as four numbers; there are FILTER / 256 at most.
    bit = F.col("k1").bitwiseAND(F.lit(FILTER - 1))
    row, word, mask = F.shiftright(bit, 8), F.shiftright(bit, 6) % 4, F.expr("shiftleft(1L, cast(k1 & 63 as int))")
    words = [F.bit_or(F.when(word == i, mask)).alias(f"w{i}") for i in range(4)]
    bits = needed.groupBy(row.alias("row")).agg(*words)
    held = F.element_at(F.array(*(F.coalesce(f"w{i}", F.lit(0)) for i in range(4))), (word + 1).cast("int"))
    texts = named.select(*key, "text").join(F.broadcast(bits), row == F.col("row"))
    texts = texts.where(held.bitwiseAND(mask) != 0).select(*key, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in W.slices(batch.column(3), lower=True, limit=SLICE_BYTES):
                _, value, n = _sorted_sets(w, None)
                columns = [x.slice(w.first, w.last - w.first) for x in batch.columns[:3]]
                columns.append(_lists(value, n))
                yield pa.RecordBatch.from_arrays(columns, names=[*key, "shingles"])

    schema = "k0 long, k1 long, k2 long, shingles array<long>"
    found = texts.mapInArrow(run, schema)
    (other,) = [c for c in wanted.columns if c != "nid"]
    found = found.join(needed, key).dropDuplicates([*key, other])
    found = stored(found.select("nid", other, "shingles"), "members")
    discard(needed)
    return found


def _most_often(pairs: DataFrame, key: str, few: int) -> DataFrame:
    """Of each key's pairs (a, b), the few that most lists propose."""
    counted = pairs.groupBy(key, "a", "b").agg(F.count(F.lit(1)).alias("lists"))
    order = Window.partitionBy(key).orderBy(F.desc("lists"), "a", "b")
    ranked = counted.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= few).select("a", "b").distinct()


def _room(n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Whether sets that first meet at these positions can still be similar."""
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    return _similar_size(small, large) & (
        F.least(n1 - p1, n2 - p2) >= _least_overlap(n1, n2)
    )


def _pivot_pairs(index: DataFrame) -> DataFrame:
    """Each set with its pivots: of the heads of its lists, the most frequent.

    A list's head is the set with the fewest rarer shingles before the list's own. Of
    many near copies it is the one that differs least from the others.
    """
    heads = index.groupBy("token").agg(F.min(F.struct("pos", "n", "nid")).alias("p"))
    pairs = index.join(heads, "token").where(
        (F.col("nid") != F.col("p.nid"))
        & _room(F.col("p.n"), F.col("p.pos"), F.col("n"), F.col("pos"))
    )
    pairs = pairs.select(F.col("nid").alias("key"), F.col("p.nid").alias("a"), F.col("nid").alias("b"))
    return _most_often(pairs, "key", PIVOTS)


def _labelled(index: DataFrame, groups: DataFrame) -> DataFrame:
    """The lists that hold sets of more than one group, with each set's component."""
    known = groups.select(F.col("node").alias("nid"), "component")
    labelled = index.join(known, "nid", "left").withColumn(
        "component", F.coalesce("component", "nid")
    )
    mixed = labelled.groupBy("token").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    mixed = mixed.where(F.col("lo") != F.col("hi")).select("token")
    return stored(labelled.join(mixed, "token", "left_semi"), "index")


def _group_pairs(labelled: DataFrame, tested: DataFrame, turn: int) -> DataFrame:
    """A few untested pairs of each group: its set and another group's in the same lists.

    At first the heads of groups and lists meet. Then what stands for them changes with
    each turn, so that a group meets ever more of its neighbours.
    """
    shuffle = F.lit(0) if not turn else F.xxhash64("nid", F.lit(turn))
    entry = F.struct(shuffle.alias("order"), "pos", "n", "nid")
    of_group = labelled.groupBy("token", "component").agg(F.min(entry).alias("e"))
    of_list = of_group.groupBy("token").agg(F.min(F.struct("e", "component")).alias("p"))
    pairs = of_group.join(of_list, "token").where(
        (F.col("component") != F.col("p.component"))
        & _room(F.col("p.e.n"), F.col("p.e.pos"), F.col("e.n"), F.col("e.pos"))
    )
    a, b = F.least("p.e.nid", "e.nid"), F.greatest("p.e.nid", "e.nid")
    pairs = pairs.select(F.col("component").alias("key"), a.alias("a"), b.alias("b"))
    return _most_often(pairs.join(tested, ["a", "b"], "left_anti"), "key", TRIES)


def _open_pairs(grouped: DataFrame) -> DataFrame:
    """Pairs of unconnected sets that size and position allow, by blocks."""
    blocks = grouped.groupBy("token", "n", "pos").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    one = blocks.select("token", *(F.col(c).alias(f"{c}1") for c in ("n", "pos", "lo", "hi")))
    two = blocks.select("token", *(F.col(c).alias(f"{c}2") for c in ("n", "pos", "lo", "hi")))
    n1, n2, p1, p2 = (F.col(c) for c in ("n1", "n2", "pos1", "pos2"))
    connected = (
        (F.col("lo1") == F.col("hi1"))
        & (F.col("lo2") == F.col("hi2"))
        & (F.col("lo1") == F.col("lo2"))
    )
    indexed = p1 < n1 - F.ceil(8 * n1 / 9) + 1
    allowed = one.join(two, "token").where(
        (n1 <= n2) & indexed & _room(n1, p1, n2, p2) & ~connected
    )
    left = grouped.select(
        "token", F.col("n").alias("n1"), F.col("pos").alias("pos1"),
        F.col("nid").alias("a"), F.col("component").alias("ca"),
    )
    right = grouped.select(
        "token", F.col("n").alias("n2"), F.col("pos").alias("pos2"),
        F.col("nid").alias("b"), F.col("component").alias("cb"),
    )
    return (
        allowed.select("token", "n1", "pos1", "n2", "pos2")
        .join(left, ["token", "n1", "pos1"])
        .join(right, ["token", "n2", "pos2"])
        .where(F.col("ca") != F.col("cb"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _derived(pairs: DataFrame, near: DataFrame, nodes: DataFrame, named: DataFrame) -> DataFrame:
    """Links among ``pairs``, from the answers of the sets' pivots where they suffice.

    ``near`` has the overlaps of sets with their pivots. For sets a, b with pivots p, q:
    |p q| - |p - a| - |q - b| <= |a b| <= |p q| + |a - p| + |b - q|.
    """
    best = near.groupBy(F.col("b").alias("nid")).agg(F.max(F.struct("both", "a", "na")).alias("p"))
    own = (
        nodes.select("nid", "n")
        .join(best, "nid", "left")
        .select(
            "nid",
            "n",
            F.coalesce("p.a", "nid").alias("pivot"),
            F.coalesce("p.na", "n").alias("size"),
            F.coalesce("p.both", "n").alias("with"),
        )
    )

    def side(name: str) -> DataFrame:
        rest = (F.col(c).alias(f"{c}_{name}") for c in own.columns[1:])
        return own.select(F.col("nid").alias(name), *rest)

    ends = {"p": F.least("pivot_a", "pivot_b"), "q": F.greatest("pivot_a", "pivot_b")}
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").withColumns(ends)
    pairs = stored(pairs, "pairs")
    every = F.explode(
        F.array(
            *(
                F.struct(F.col(c).alias("nid"), F.lit(c in ends).alias("pivot"))
                for c in ("a", "b", "p", "q")
            )
        )
    )
    wanted = pairs.select(every.alias("w")).select("w.nid", "w.pivot")
    wanted = wanted.groupBy("nid").agg(F.max("pivot").alias("pivot"))
    members = _members(named, nodes, wanted)
    pivots = members.where("pivot")
    asked = pairs.select(F.col("p").alias("a"), F.col("q").alias("b")).distinct()
    answers = _overlaps(asked, pivots, pivots).select(
        F.col("a").alias("p"), F.col("b").alias("q"), F.col("both").alias("answer")
    )
    least = _least_overlap(F.col("n_a"), F.col("n_b"))
    most = F.col("answer") + F.col("n_a") - F.col("with_a") + F.col("n_b") - F.col("with_b")
    sure = F.col("answer") - F.col("size_a") + F.col("with_a") - F.col("size_b") + F.col("with_b")
    bounded = pairs.join(answers, ["p", "q"]).where(most >= least)
    bounded = stored(bounded.select("a", "b", (sure >= least).alias("sure")), "bounded")
    unsure = bounded.where(~F.col("sure")).select("a", "b")
    compared = _overlaps(unsure, members, members)
    linked = F.col("both") >= _least_overlap(F.col("na"), F.col("nb"))
    found = bounded.where("sure").select("a", "b").union(compared.where(linked).select("a", "b"))
    found = stored(found, "derived")
    for table in (pairs, members, bounded):
        discard(table)
    return found


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Links:
    """Groups of documents linked by a Jaccard of 0.8 or more of five-word shingles.

    Words are lower-cased in A-Z. A null or empty text has no shingles and no links; a
    text of fewer than five words has one shingle. Equal sets are one node, so copies
    are linked by belonging to it. A row without an id takes part, but names no group.
    Only the two named columns are read. An empty table gives empty tables.
    ``links`` connects the same nodes as all pairs would: pairs inside a group that is
    already connected are left out.
    """
    named = keyed(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(frequencies(named))
    whole = stored(sets(named, shared), "sets")
    shared.destroy()
    full = (
        whole.where(F.col("n") > 0)
        .groupBy("f1", "f2")
        .agg(
            F.first("n").alias("n"),
            F.min("doc_id").alias("doc"),
            F.min(F.struct("doc_id", "k0", "k1", "k2")).alias("rep"),
            F.first("prefix").alias("prefix"),
            F.first("rare").alias("rare"),
        )
        .withColumn("nid", F.monotonically_increasing_id())
    )
    full = stored(full, "nodes")
    index = _index(full)
    # The prefixes have done their work; what stays is thin.
    documents = stored(whole.drop("prefix", "rare"), "documents")
    nodes = stored(full.drop("prefix", "rare"), "nodes")
    discard(whole)
    discard(full)
    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("nid"), F.lit(True).alias("pivot")).union(
            pairs.select("b", F.lit(False))
        )
        wanted = wanted.groupBy("nid").agg(F.max("pivot").alias("pivot"))
        members = _members(named, nodes, wanted)
        found = stored(_overlaps(pairs, members.where("pivot"), members), "compared")
        discard(members)
        discard(pairs)
        return found

    linked = F.col("both") >= _least_overlap(F.col("na"), F.col("nb"))
    compared = _with_pivots(stored(_pivot_pairs(index), "pairs"), nodes, named)
    groups = components(compared.where(linked).select("a", "b"))
    labelled = _labelled(index, groups)
    discard(index)
    for turn in range(MERGES):
        ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        pairs = stored(_group_pairs(labelled, compared.select(*ends), turn), "pairs")
        if pairs.isEmpty():
            break
        more = verified(pairs)
        grown = stored(compared.union(more), "compared")
        discard(compared)
        compared = grown
        if not more.where(linked).isEmpty():
            groups = components(compared.where(linked).select("a", "b"))
            older = labelled
            labelled = _labelled(older.drop("component"), groups)
            discard(older)
        discard(more)
    links = compared.where(linked).select("a", "b")
    tested = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = _open_pairs(labelled).join(tested, ["a", "b"], "left_anti")
    rest = stored(rest, "open")
    discard(labelled)
    if not rest.isEmpty():
        more = _derived(rest, compared.where(linked), nodes, named)
        links = stored(links.union(more), "links")
        groups = components(links)
    return Links(documents, nodes, links, groups)


def grouped(found: Links) -> DataFrame:
    """Every document with its set's class_id and its component_id.

    Both are smallest ids; a document without shingles is its own.
    """
    labels = found.nodes.select("nid", "f1", "f2", "doc").join(
        found.groups.withColumnRenamed("node", "nid"), "nid", "left"
    )
    labels = stored(
        labels.withColumn("component", F.coalesce("component", "nid")), "labels"
    )
    first = labels.groupBy("component").agg(F.min("doc").alias("least"))
    labels = labels.join(first, "component").select("f1", "f2", "component", "doc", "least")
    none = F.col("n") == 0
    return found.documents.join(labels, ["f1", "f2"], "left").select(
        "doc_id",
        "k0",
        "k1",
        "k2",
        F.col("n").alias("n_shingles"),
        F.when(~none, F.col("component")).alias("node"),
        F.when(none, F.col("doc_id")).otherwise(F.col("doc")).alias("class_id"),
        F.when(none, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked documents, that of the smallest id.

    Documents without shingles all stay. Rows equal in id and text stay once. All
    columns are kept as they are, whatever their names.
    """
    rows = stored(grouped(join(docs, doc_id, text)), "grouped")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k0", "k1", "k2")
    key = ["k0", "k1", "k2"]
    kept = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(order).alias("r"))
    kept = kept.select(*(f"r.{c}" for c in key)).union(
        rows.where(F.col("node").isNull()).select(*key).distinct()
    )
    own, name = apart(docs)
    own = own.withColumns(keys(name[doc_id], name[text]))
    # Rows of one key meet in the join already, so the texts move once.
    once = own.join(kept, key, "left_semi").dropDuplicates(key)
    return once.select(*name.values()).toDF(*docs.columns)
