"""Words and word shingles of an Arrow column of texts, as numpy arrays.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D). Words are
hashed to 64 bits, all words of a slice at once: each byte stands for a random
number, weighted by its place, and the sum is mixed. A slice holds whole texts up to
about ``SLICE_BYTES``, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes so that every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def randoms(n: int, stream: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers; each stream has its own."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(stream << 32)
    return mix(steps * _GOLDEN) | np.uint64(1)


_BYTE = randoms(256, 1)
_BYTE[SPACE] = 0
_LOWER = _BYTE.copy()
_LOWER[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_STEP = randoms(4096, 2)
_TAG = randoms(64, 3)
_places = randoms(256, 4)


def places(n: int) -> np.ndarray:
    """A weight for each of the first ``n`` places in a word or sequence."""
    global _places
    if n > len(_places):
        _places = randoms(max(n, 2 * len(_places)), 4)
    return _places[:n]


@dataclass
class Words:
    """All words of the texts ``first`` to ``last`` (not included) of a column."""

    first: int
    last: int
    bytes: np.ndarray  # of all these texts
    text_at: np.ndarray  # where each text begins in bytes, and the end
    doc: np.ndarray  # of each word: its text, from 0
    start: np.ndarray  # of each word: its place in bytes
    end: np.ndarray
    hash: np.ndarray
    per_doc: np.ndarray  # of each text: its number of words

    @property
    def word_at(self) -> np.ndarray:
        """Where the words of each text begin, and the number of all words."""
        return np.concatenate(([0], np.cumsum(self.per_doc)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at.astype(np.int64)


def cut(raw: np.ndarray, at: np.ndarray, first: int, last: int, lower: bool = False) -> Words:
    b = raw[at[first] : at[last]]
    text_at = at[first : last + 1] - at[first]
    n = len(b)
    space = SPACE[b]
    begins = ~space
    ends = begins.copy()
    inner = text_at[(text_at > 0) & (text_at < n)]
    begins[1:] &= space[:-1]
    begins[inner] = ~space[inner]
    ends[:-1] &= space[1:]
    ends[inner - 1] = ~space[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    doc = np.searchsorted(text_at, start, side="right") - 1
    if len(start):
        length = end - start
        table = _LOWER if lower else _BYTE
        head = start[0]
        spread = np.diff(start, append=n)
        place = np.arange(head, n) - np.repeat(start, spread)
        weight = places(int(length.max()))
        value = table[b[head:]] * weight[np.minimum(place, len(weight) - 1)]
        hashed = mix(np.add.reduceat(value, start - head) + length.astype(np.uint64))
    else:
        hashed = np.zeros(0, np.uint64)
    per_doc = np.bincount(doc, minlength=last - first)
    return Words(first, last, b, text_at, doc, start, end, hashed, per_doc)


def slices(column: pa.Array, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a column, a slice of whole texts at a time."""
    raw, at = utf8(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield cut(raw, at, first, last, lower)
        first = last


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; memory that Arrow kept of one is given back before the next is read."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all ``k`` consecutive words of one text, and their hashes."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.doc[:n] == w.doc[k - 1 :])
    total = np.zeros(len(at), np.uint64)
    for j in range(k):
        total += w.hash[at + j] * _STEP[j]
    return at, mix(total + _TAG[min(k, 63)])


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each shingle of ``k`` words, repeats included.

    A text with fewer words has one shingle, its whole sequence; one without words
    has none.
    """
    at, value = windows(w, k)
    docs, values = [w.doc[at]], [value]
    first = w.word_at
    for few in range(1, k):
        short = np.flatnonzero(w.per_doc == few)
        if len(short):
            total = np.zeros(len(short), np.uint64)
            for j in range(few):
                total += w.hash[first[short] + j] * _STEP[j]
            docs.append(short)
            values.append(mix(total + _TAG[few]))
    return np.concatenate(docs), np.concatenate(values)


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return h.view(np.int64)
