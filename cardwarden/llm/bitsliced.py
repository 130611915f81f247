"""Exact top-k search by inner product over a bit-sliced index.

Vectors are quantised to integers. A block of them is kept as bitmaps: for each component
and each bit of its distance from the block's least value, the rows that have the bit. A
query's scores over a block are a sum of such bitmaps, shifted by the bits of the query's
components and added by carry-save adders, a word of 64 rows at a time; where a component
of the query is negative, the distance from the greatest value is added. Only the
``SLICES`` most significant bits are added, so a score is known up to a bound. The k-th
highest score is found from its most significant bit downward, and the rows that the bound
leaves at the boundary are resolved by their exact inner products.

Blocks are made where the rows are read; queries stream past each block, so a task holds
one block and a batch of queries. No row is left out, and no pair of rows is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.session import stored

#: Steps of a unit, and rows of a block.
SCALE, BLOCK = 256.0, 8192
#: Most significant bits of a component that are added as bitmaps.
SLICES = 6
#: Queries whose bitmaps are added at once, and rows of a batch of results.
TOGETHER = 16

_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
_ORDER = ["vec_id", "rid"]


def quantised(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """rid, vec_id, v: the usable vectors as integers, floor(256 x), each row with its own rid.

    A vector that is null or empty, or holds a null or non-finite component, takes no part,
    nor does one so long that an inner product might not fit in 64 bits.
    """
    x = F.col("x")
    values = rows.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(vec_id).alias("vec_id"),
        F.transform(F.col(embedding), lambda x: x.cast("double") * SCALE).alias("x"),
    )
    # NaN is greater than any number.
    fit = F.forall(x, lambda v: F.coalesce(v * v * F.size(x) < 2.0**61, F.lit(False)))
    usable = values.where(x.isNotNull() & (F.size(x) > 0) & fit)
    return stored(usable.select("rid", "vec_id", F.transform(x, lambda v: F.floor(v)).alias("v")), "quantised")


def _block(rid: np.ndarray, ids: pa.Array, values: np.ndarray, name: int) -> pa.RecordBatch:
    """The index rows of a block: its ids, then each component's integers and bitmaps."""
    n, dims = values.shape
    low = values.min(axis=0)
    width = [int(w).bit_length() for w in values.max(axis=0) - low]
    drop = max(0, max(width) - SLICES)
    away = (values - low).astype(np.uint64)
    known = np.zeros(-(-n // 64) * 64, bool)
    data = [rid.astype(np.int64).tobytes()]
    for d in range(dims):
        maps = []
        for bit in range(drop, width[d]):
            known[:n] = (away[:, d] >> np.uint64(bit)) & np.uint64(1)
            maps.append(np.packbits(known, bitorder="little").tobytes())
        data.append(values[:, d].tobytes() + b"".join(maps))
    columns = [
        pa.array([name] * (dims + 1), pa.int64()),
        pa.array([dims] * (dims + 1), pa.int32()),
        pa.array(range(dims + 1), pa.int32()),
        pa.array([n] * (dims + 1), pa.int32()),
        pa.array([drop] * (dims + 1), pa.int32()),
        pa.array([0, *low.tolist()], pa.int64()),
        pa.array([0, *width], pa.int32()),
        pa.array(data, pa.large_binary()).cast(pa.binary()),
        pa.array([ids] + [None] * dims, pa.list_(ids.type)),
    ]
    names = ["block", "dims", "part", "n", "drop", "low", "width", "data", "ids"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def index(vectors: DataFrame) -> DataFrame:
    """Blocks of bit slices over all ``vectors`` (rid, vec_id, v), made without a shuffle."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[pa.Table]] = {}

        def made(dims: int) -> pa.RecordBatch:
            table = pa.concat_tables(waiting.pop(dims))
            # A block's rows stand in order of their ids, so ties fall to the first.
            table = table.sort_by([("vec_id", "ascending"), ("rid", "ascending")]).combine_chunks()
            flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            rid = table.column("rid").to_numpy()
            ids = table.column("vec_id").to_pylist()
            ids = pa.array(ids, table.schema.field("vec_id").type)
            return _block(rid, ids, flat.reshape(len(rid), dims), int(rid.min()))

        for batch in batches:
            table = pa.Table.from_batches([batch])
            lengths = pa.compute.list_value_length(table.column("v")).to_numpy()
            for dims in np.unique(lengths).tolist():
                own = table.filter(pa.array(lengths == dims))
                for at in range(0, own.num_rows, BLOCK):
                    waiting.setdefault(dims, []).append(own.slice(at, BLOCK))
                    if sum(t.num_rows for t in waiting[dims]) >= BLOCK:
                        yield made(dims)
            if sum(t.num_rows for held in waiting.values() for t in held) >= 4 * BLOCK:
                for dims in list(waiting):  # of very many lengths
                    yield made(dims)
        for dims in list(waiting):
            yield made(dims)

    schema = (
        "block long, dims int, part int, n int, drop int, low long, width int, data binary, "
        f"ids array<{kind}>"
    )
    return stored(vectors.mapInArrow(run, schema), "slices")


class _Heap:
    """Bitmaps by significance, added without carries as long as two of each are left."""

    def __init__(self):
        self.at: list[list[np.ndarray]] = []

    def push(self, p: int, x: np.ndarray) -> None:
        while True:
            while len(self.at) <= p:
                self.at.append([])
            held = self.at[p]
            held.append(x)
            if len(held) < 3:
                return
            a, b, c = held
            u = a ^ b
            self.at[p] = [u ^ c]
            p, x = p + 1, (a & b) | (u & c)

    def sums(self) -> list[np.ndarray]:
        """One bitmap for each bit of the sums."""
        p = 0
        while p < len(self.at):
            while len(self.at[p]) > 1:
                a, b = self.at[p].pop(), self.at[p].pop()
                self.at[p].insert(0, a ^ b)
                if p + 1 == len(self.at):
                    self.at.append([])
                self.at[p + 1].append(a & b)
            p += 1
        return [held[0] if held else None for held in self.at]


class _Block:
    """A block of the index in memory."""

    def __init__(self, n: int, dims: int):
        self.n, self.words = n, -(-n // 64)
        self.values = np.empty((n, dims), np.int64)
        self.low, self.maps = np.zeros(dims, np.int64), [None] * dims
        self.width = np.zeros(dims, np.int64)
        self.rid, self.ids, self.drop = None, None, 0
        self.all = np.zeros(self.words * 8, np.uint8)
        whole = np.packbits(np.ones(n, bool), bitorder="little")
        self.all[: len(whole)] = whole
        self.all = self.all.view(np.uint64)

    def add(self, part: int, drop: int, low: int, width: int, data: bytes, ids) -> None:
        if part == 0:
            self.rid, self.ids, self.drop = np.frombuffer(data, np.int64), ids, drop
            return
        d, size = part - 1, 8 * self.n
        self.values[:, d] = np.frombuffer(data[:size], np.int64)
        self.low[d], self.width[d] = low, width
        self.maps[d] = np.frombuffer(data[size:], np.uint64).reshape(-1, self.words)

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query: its number, the rows of its k best and their scores."""
        q = len(queries)
        valid = np.repeat(self.all[None, :], q, axis=0)
        for i, rid in enumerate(own):
            for row in np.flatnonzero(self.rid == rid):
                valid[i, row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        size = np.abs(queries).astype(np.uint64)
        turned = np.where(queries < 0, _ONES, np.uint64(0))
        heap = _Heap()
        for d, maps in enumerate(self.maps):
            for j in range(int(size[:, d].max()).bit_length()):
                has = np.where((size[:, d] >> np.uint64(j)) & np.uint64(1), _ONES, np.uint64(0))
                if has.any():
                    for i, bitmap in enumerate(maps):
                        x = (bitmap[None, :] ^ turned[:, d, None]) & has[:, None]
                        heap.push(i + j, x)
        sums = [x if x is not None else np.zeros_like(valid) for x in heap.sums()]
        edge = self._boundary(sums, valid, size.sum(axis=1), k)
        for i in range(q):
            rows = np.flatnonzero(np.unpackbits(edge[i].view(np.uint8), bitorder="little")[: self.n])
            score = self.values[rows] @ queries[i]
            best = np.argsort(-score, kind="stable")[:k]
            yield i, rows[best], score[best]

    def _boundary(self, sums, valid, weight, k) -> np.ndarray:
        """The rows that may be among the k best of each query.

        Sums count whole steps of 2^drop and are short of the score by less than one step
        for each unit of the query's components.
        """
        q = len(valid)
        sure, maybe = np.zeros_like(valid), valid.copy()
        found = np.zeros(q, object)
        for p in range(len(sums) - 1, -1, -1):
            x = maybe & sums[p]
            enough = np.bitwise_count(sure | x).sum(axis=1) >= k
            found = found + np.where(enough, 1 << p, 0).astype(object)
            sure = np.where(enough[:, None], sure, sure | x)
            maybe = np.where(enough[:, None], x, maybe & ~sums[p])
        slack = weight.astype(object) if self.drop else np.zeros(q, object)
        least = np.maximum(found - slack, 0)
        few = np.bitwise_count(valid).sum(axis=1) <= k
        above, equal = np.zeros_like(valid), valid.copy()
        for p in range(len(sums) - 1, -1, -1):
            bit = np.array([(int(x) >> p) & 1 for x in least], bool)[:, None]
            above = np.where(bit, above, above | (equal & sums[p]))
            equal = np.where(bit, equal & sums[p], equal & ~sums[p])
        return np.where(few[:, None], valid, above | equal)


def _answers(dealt: DataFrame, kind: str, k: int) -> DataFrame:
    """Each query's best rows in each block, as blocks and the queries after them stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, name = None, None
        for batch in batches:
            asked = batch.column("part").to_numpy() < 0
            names = batch.column("block").to_numpy()
            cut = np.flatnonzero((names[1:] != names[:-1]) | (asked[1:] != asked[:-1])) + 1
            edges = [0, *cut.tolist(), batch.num_rows]
            for first, last in zip(edges[:-1], edges[1:], strict=True):
                if first == last:
                    continue
                some = batch.slice(first, last - first)
                if not asked[first]:
                    for row in some.drop_columns(["rid", "vec_id", "v"]).to_pylist():
                        if row["block"] != name:
                            name, block = row["block"], _Block(row["n"], row["dims"])
                        block.add(*(row[c] for c in ("part", "drop", "low", "width", "data", "ids")))
                    continue
                for at in range(0, len(some), TOGETHER):
                    yield from answered(block, some.slice(at, TOGETHER))

    def answered(block: _Block, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rid, ids = some.column("rid").to_numpy(), some.column("vec_id").to_pylist()
        values = some.column("v").flatten().to_numpy(zero_copy_only=False)
        found = ([], [], [], [], [])
        for i, rows, score in block.top(values.reshape(len(rid), -1), rid, k):
            found[0].extend([rid[i]] * len(rows))
            found[1].extend([ids[i]] * len(rows))
            found[2].extend(block.rid[rows].tolist())
            found[3].extend(block.ids[row] for row in rows)
            found[4].extend(score.tolist())
        kinds = (pa.int64(), some.schema.field("vec_id").type, pa.int64())
        kinds += (some.schema.field("vec_id").type, pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(found, kinds, strict=True)]
        names = ["query_rid", "query_id", "rid", "vec_id", "score"]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"query_rid long, query_id {kind}, rid long, vec_id {kind}, score long"
    return dealt.mapInArrow(run, schema)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k highest inner products of each query with all other rows of its length.

    ``vectors`` is what ``quantised`` gives and ``queries`` some of its rows. Returns
    query_id, rank (from 1), vec_id, score; equal scores go to the smaller vec_id, null
    last. A row is not compared with itself; repeated rows, also of one id, are compared
    with each other. With fewer than k other rows, all are returned.
    """
    slices = index(vectors)
    blocks = slices.where(F.col("part") == 0).select("block", "dims")
    asked = queries.withColumn("dims", F.size("v"))
    # Every block meets every query of its length: as queries that stream past it.
    asked = asked.join(blocks, "dims").withColumn("part", F.lit(-1))
    names = [*slices.columns, "rid", "vec_id", "v"]
    dealt = slices.unionByName(asked, allowMissingColumns=True).select(*names)
    # Queries stand after the block: its rows have the higher parts.
    turn = F.when(F.col("part") < 0, F.lit(1)).otherwise(F.lit(0))
    dealt = dealt.repartition("block").sortWithinPartitions("block", turn, "part")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    found = stored(_answers(dealt, kind, k), "answers")
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), "rid"]
    rank = F.row_number().over(Window.partitionBy("query_rid").orderBy(*order))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
