"""Tables of a fixed size, filled by all tasks and merged on Spark."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_BLOCK = 1 << 16
_SCHEMA = "block int, part binary"


def gathered(
    rows: DataFrame,
    fill: Callable[[np.ndarray, pa.RecordBatch], None],
    size: int,
    kind: type,
    merge: Callable = np.add,
) -> np.ndarray:
    """One array of ``size`` values from all rows, whatever their number.

    Every task fills its own array from its batches. The arrays are cut into blocks,
    compressed, and merged block by block, so that only the result reaches the driver.
    """

    def out(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
        packed = [zlib.compress(x.tobytes(), 1) for x in blocks.values()]
        columns = [pa.array(list(blocks), pa.int32()), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "part"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, kind)
        for batch in batches:
            fill(own, batch)
        parts = {i: own[at : at + _BLOCK] for i, at in enumerate(range(0, size, _BLOCK))}
        parts = {i: x for i, x in parts.items() if x.any()}
        if parts:
            yield out(parts)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(zlib.decompress(x), kind)
                blocks[i] = merge(blocks[i], part) if i in blocks else part
        if blocks:
            yield out(blocks)

    found = np.zeros(size, kind)
    parts = rows.mapInArrow(each, _SCHEMA).repartition("block").mapInArrow(merged, _SCHEMA)
    for row in parts.collect():
        value = np.frombuffer(zlib.decompress(bytes(row.part)), kind)
        found[row.block * _BLOCK : row.block * _BLOCK + len(value)] = value
    return found
