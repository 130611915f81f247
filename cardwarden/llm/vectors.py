"""Embedding near-duplicates: iterative quantisation and multi-index Hamming tables.

A rotation that balances binary codes is learned on a bounded sample. Every vector's
code is cut into substrings, one for each hash table; two vectors meet in a table when
their substrings differ in at most one bit. A pair that meets is compared once, with
the original vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.components import components
from cardwarden.session import stored

THRESHOLD = 0.93
#: Values and vectors of the sample that the rotation is learned from; they bound the
#: driver's share.
SAMPLE_VALUES, SAMPLE_ROWS = 1 << 20, 8192
#: Vectors of the sample this close to an earlier one are left out of the fit. Else a
#: large group of near copies would draw the cuts of the codes through itself.
APART = 0.8
#: Tried in turn where the vectors are so close together that too few would be left.
CLOSER = (0.93, 0.98)
ROUNDS = 40
#: Share of the pairs right at the threshold that may meet nowhere.
MISSED = 0.02
#: Pairs made at the threshold to measure it, of each of two kinds.
TRIED = 2048
#: Work of comparing two vectors, in rows of a table.
COMPARED = 0.02
#: Vectors of a bucket that are compared as one block.
BLOCK = 1024


@dataclass
class Tables:
    """``bits`` of a substring, how many ``tables``, and the rotations with their medians."""

    size: int
    bits: int
    tables: int
    mean: np.ndarray
    rotation: np.ndarray
    middle: np.ndarray


def shape_of(largest: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits of a substring and tables, for the number of vectors under one label.

    A substring has about as many values as there are vectors, so a bucket holds a few
    at any size; tables are added until a pair at the threshold is missed rarely.
    """
    bits = min(30, max(12, math.ceil(math.log2(max(2, largest))) + 2))
    return bits, _tables(bits, math.acos(threshold) / math.pi)


def _tables(bits: int, flip: float) -> int:
    """Tables for bits that flip at random."""
    meet = (1 - flip) ** bits + bits * flip * (1 - flip) ** (bits - 1)
    return 1 if meet >= 1 - MISSED else math.ceil(math.log(MISSED) / math.log(1 - meet))


def _cheapest(most: int, flip: float, largest: int) -> int:
    """Bits, ``most`` at most, with the least work: rows of tables and comparisons."""

    def work(bits: int) -> float:
        return _tables(bits, flip) * bits * (1 + COMPARED * largest / 2 ** (bits - 1))

    return min(range(1, most + 1), key=work)


def _spread(sample: np.ndarray) -> np.ndarray:
    """Unit vectors without those close to an earlier one, if that leaves enough to learn."""
    first = _apart(sample, APART)
    for limit in CLOSER:
        if len(first) >= min(len(sample) / 2, 8 * sample.shape[1]):
            return first
        more = _apart(sample, limit)
        if len(more) >= 8 * sample.shape[1]:
            return more
    return first


def _apart(sample: np.ndarray, limit: float) -> np.ndarray:
    keep = np.ones(len(sample), bool)
    for at in range(0, len(sample), 1024):
        rows = np.arange(at, min(at + 1024, len(sample)))
        near = sample[rows] @ sample[: rows[-1] + 1].T >= limit
        keep[rows] = ~(near & (np.arange(rows[-1] + 1) < rows[:, None])).any(axis=1)
    return sample[keep]


def learn(sample: np.ndarray, bits: int, tables: int) -> Tables:
    """Rotations by iterative quantisation: as many as the code has blocks of dimensions.

    Each starts from a random rotation of the centred sample and alternates between the
    nearest binary code and the rotation that fits it best.
    """
    size = sample.shape[1]
    sample = _spread(sample)
    mean = sample.mean(axis=0)
    centred = sample - mean
    random = np.random.default_rng(20)
    parts = []
    for _ in range(math.ceil(bits * tables / size)):
        turn, _ = np.linalg.qr(random.standard_normal((size, size)))
        for _ in range(ROUNDS):
            code = np.where(centred @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(centred.T @ code)
            turn = left @ right
        parts.append(turn)
    rotation = np.hstack(parts)[:, : bits * tables]
    return Tables(size, bits, tables, mean, rotation, np.median(centred @ rotation, axis=0))


def _partners(sample: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors at the threshold, of two kinds: towards any side, and towards
    where vectors of the sample differ."""
    random = np.random.default_rng(21)
    x = sample[random.permutation(len(sample))[:TRIED]]
    other = sample[random.integers(len(sample), size=(2, len(x)))]
    sides = (random.standard_normal(x.shape), other[0] - other[1])
    near = []
    for side in sides:
        side = side - (side * x).sum(axis=1)[:, None] * x
        size = np.sqrt((side * side).sum(axis=1))[:, None]
        side = side / np.where(size > 1e-9, size, np.inf)
        near.append(_units(threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * side))
    return x, np.stack(near)


def _flips(model: Tables, x: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Which bits differ, by kind, pair, table and bit."""
    bit = [(y - model.mean) @ model.rotation > model.middle for y in (x, *near)]
    shape = (len(near), len(x), model.tables, model.bits)
    return np.stack([b != bit[0] for b in bit[1:]]).reshape(shape)


def fitted(sample: np.ndarray, largest: int, threshold: float = THRESHOLD) -> Tables:
    """Tables in which pairs at the threshold meet, as measured with the fitted codes.

    Angles about the mean are larger than cosines say where vectors have a common
    direction, and bits flip more often. Tables are then added, and substrings cut shorter
    where that is less work, until no more pairs than ``MISSED`` meet nowhere.
    """
    x, near = _partners(sample, threshold)
    bits, tables = shape_of(largest, threshold)
    first = True
    while True:
        model = learn(sample, bits, tables)
        flips = _flips(model, x, near)
        met = (flips.sum(axis=3) <= 1).any(axis=2).mean(axis=1).min()
        if met >= 1 - MISSED or bits == 1:
            return model
        flip = min(0.5, flips.mean(axis=(1, 2, 3)).max())
        if first or tables > 4 * _tables(bits, flip):
            bits = _cheapest(bits if first else bits - 1, flip, largest)
            tables = _tables(bits, flip)
            first = False
        else:
            tables = math.ceil(1.25 * tables)


def _units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _valid(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _codes(rows: DataFrame, model: Tables) -> DataFrame:
    """``rows`` (node, size, vector) with a code, one integer for each table.

    Vectors of another size than the sample's are coded by their own signs, repeated.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        weight = 1 << np.arange(m.bits, dtype=np.int64)
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            code = np.zeros((len(sizes), m.tables), np.int64)
            lists = batch.column(2)
            value = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            end = np.cumsum(sizes)
            for n in np.unique(sizes):
                which = np.flatnonzero(sizes == n)
                x = value[(end[which] - n)[:, None] + np.arange(n)]
                x = _units(x)
                if n == m.size:
                    bit = (x - m.mean) @ m.rotation > m.middle
                else:
                    bit = x[:, np.arange(m.bits * m.tables) % n] > 0
                code[which] = bit.reshape(len(which), m.tables, m.bits) @ weight
            at = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * m.tables)
            codes = pa.ListArray.from_arrays(at, pa.array(code.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), codes], names=["node", "code"])

    return rows.select("node", "size", "vector").mapInArrow(run, "node long, code array<long>")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what ``a`` and ``b`` connect, at most one for each node."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _compare(rows: DataFrame, threshold: float) -> DataFrame:
    """Sums and links of every pair that meets, each pair in one place.

    ``rows`` are bucket, place (table and free bit), node, copies, code and vector,
    a bucket's rows in one task. A pair belongs to the first table where it meets, at
    the bit that differs or the first. Returns (node, links, other): copies linked to
    the node, or with other set a link of a forest, so no row is made for a pair.
    """

    def pairs(table: pa.Table) -> pa.RecordBatch:
        bucket = table["group"].to_numpy()
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        free, side = table["place"].to_numpy(), table["side"].to_numpy()
        n = len(node)
        code = table["code"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        lists = table["vector"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        value = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        end = np.cumsum(sizes)
        found_a, found_b = [], []
        edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        count = np.diff(np.append(edge, n))
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            x = np.zeros((n, size)) if len(own) < n else None
            have = _units(value[(end[own] - size)[:, None] + np.arange(size)])
            if x is None:
                x = have
            else:
                x[own] = have
            for lag in range(1, min(32, int(count.max()))):
                i = np.flatnonzero(bucket[lag:] == bucket[:-lag])
                i = i[np.repeat(count, count)[i] <= 32]
                if len(i):
                    near = np.einsum("ij,ij->i", x[i], x[i + lag]) >= threshold
                    found_a.append(i[near])
                    found_b.append(i[near] + lag)
            for start, m in zip(edge[count > 32], count[count > 32], strict=True):
                block = x[start : start + m]
                for low in range(0, m, 512):
                    near = block[low : low + 512] @ block[low:].T >= threshold
                    i, j = np.nonzero(near)
                    later = j > i
                    found_a.append(start + low + i[later])
                    found_b.append(start + low + j[later])
        a = np.concatenate([*found_a, np.zeros(0, np.int64)]).astype(np.int64)
        b = np.concatenate([*found_b, np.zeros(0, np.int64)]).astype(np.int64)
        differ = code[a] ^ code[b]
        meet = (differ & (differ - 1)) == 0
        first = meet.argmax(axis=1)
        bits = differ[np.arange(len(a)), first]
        bit = np.where(bits > 0, np.log2(np.maximum(bits, 1)), 0).astype(np.int64)
        # Of two parts of a bucket, pairs inside one are compared where it stands alone.
        across = (side[a] < 0) | (side[a] != side[b])
        use = meet.any(axis=1) & (free[a] == first * 64 + bit) & across & (node[a] != node[b])
        a, b = a[use], b[use]
        ids = np.concatenate((node[a], node[b]))
        names, where = np.unique(ids, return_inverse=True)
        sums = np.zeros(len(names), np.int64)
        np.add.at(sums, where, np.concatenate((copies[b], copies[a])))
        left, right = _forest(node[a], node[b])
        columns = [
            pa.array(np.concatenate((names, left)), pa.int64()),
            pa.array(np.concatenate((sums, np.zeros(len(left), np.int64))), pa.int64()),
            pa.array([None] * len(names) + right.tolist(), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["node", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column(0).to_numpy()
            same = np.flatnonzero(group != group[-1])
            whole = int(same[-1]) + 1 if len(same) else 0
            if whole or (held and held[-1].column(0)[0].as_py() != group[0]):
                yield pairs(pa.Table.from_batches([*held, batch.slice(0, whole)]))
                held = []
            held.append(batch.slice(whole))
        if held:
            yield pairs(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "node long, links long, other long")


def near_duplicates(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row, compared under equal labels.

    A vector that is null, empty, zero, or has null or non-finite components, and one
    without a label, links with nothing; so do vectors of different sizes. Equal vectors
    are one node with a number of copies, so a repeated vector costs nothing. A row
    without an id counts as a link, names no component and is not kept. An empty table
    gives an empty result.

    Large buckets are compared block by block in many tasks; only sums and a forest
    leave a task, never all pairs.
    """
    given = rows.select(
        F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label")
    )
    key = ("label", "vector")
    given = given.withColumns(
        {
            "ok": F.coalesce(_valid(F.col("vector")), F.lit(False)) & F.col("label").isNotNull(),
            "h1": F.xxhash64(*key),
            "h2": F.xxhash64(F.lit(1), *key),
        }
    )
    nodes = (
        given.where("ok")
        .groupBy("h1", "h2")
        .agg(
            F.min("vec_id").alias("least"),
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
        )
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("size", F.size("vector"))
    )
    nodes = stored(nodes, "vectors")
    labels = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    largest = labels.agg(F.max("n")).first()[0] or 1
    usual = nodes.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    size = usual["size"] if usual else 1
    take = max(2, min(SAMPLE_ROWS, SAMPLE_VALUES // size))
    sample = nodes.where(F.col("size") == size).orderBy(F.xxhash64("h1"), "h1").limit(take)
    values = np.array([r.vector for r in sample.select("vector").collect()], np.float64)
    if len(values):
        model = fitted(_units(values.reshape(-1, size)), largest, threshold)
    else:
        model = learn(np.zeros((1, size)), *shape_of(largest, threshold))
    bits, tables = model.bits, model.tables
    coded = stored(_codes(nodes, model), "codes")

    # One row for each table and bit left free.
    place = F.explode(F.array([F.lit(t * 64 + j) for t in range(tables) for j in range(bits)]))
    table = F.shiftright("place", 6)
    part = F.element_at("code", table + 1)
    masked = part.bitwiseAND(F.bitwise_not(_bit(F.col("place"))))
    keyed = (
        coded.join(nodes.select("node", "label", "size"), "node")
        .select("node", "code", "label", "size", place.alias("place"))
        .select("node", "label", "size", "place", masked.alias("key"))
    )
    bucket = ["label", "size", "place", "key"]
    full = keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    meet = keyed.join(full, bucket).withColumn("parts", parts)
    mine = F.pmod(F.xxhash64("node", "place"), F.col("parts")).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    meet = meet.withColumn("mine", mine).withColumn("with", F.explode(others))
    low, high = F.least("mine", "with"), F.greatest("mine", "with")
    group = F.xxhash64(*bucket, low, high)
    side = F.when(F.col("mine") == F.col("with"), -1).otherwise((F.col("mine") > F.col("with")).cast("int"))
    meet = meet.select("node", "place", group.alias("group"), side.alias("side"))
    whole = coded.join(nodes.select("node", "copies", "vector"), "node")
    ready = meet.join(whole, "node").select(
        "group", "place", "side", "node", "copies", "code", "vector"
    )
    ready = ready.repartition("group").sortWithinPartitions("group", "place", "node")
    found = stored(_compare(ready, threshold), "found")

    groups = components(found.where(F.col("other").isNotNull()).select("node", "other"))
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "h1", "h2", "least", "copies").join(sums, "node", "left")
    named = named.join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    named = stored(named, "named")
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(first, "component").select(
        "h1",
        "h2",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        "component_id",
        F.lit(True).alias("ok"),
    )
    out = given.select("vec_id", "h1", "h2", "ok").join(named, ["h1", "h2", "ok"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _bit(place: Column) -> Column:
    """The free bit of a place."""
    return F.pow(F.lit(2.0), place.bitwiseAND(63)).cast("long")
