"""Quality rules: repetition counts, and bands of compression ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm import words as W

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANKS = b" \t\r\x0b\x0c"
WINDOW = 5


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size by raw size, for texts of each length.

    ``whole`` has (least bytes of text, lowest ratio, highest ratio), ``chunks`` (least
    bytes of text, bytes of a chunk, lowest, highest), in rising order of bytes; the last
    line that a text reaches holds. Short texts carry a frame of a fixed size and little
    to repeat, so their ratios lie higher, and below 200 bytes prose is no more
    compressible than noise, so there is no highest. A text is cut into full chunks; where
    bytes are left over, its last bytes are one more chunk, which overlaps the one before.
    It is rejected when over ``chunk_share`` of its chunks are outside.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 9.9),
        (30, 0.80, 9.9),
        (60, 0.60, 9.9),
        (100, 0.45, 9.9),
        (200, 0.30, 0.95),
        (1_000, 0.28, 0.80),
        (4_000, 0.25, 0.70),
        (16_000, 0.22, 0.65),
    )
    chunks: tuple[tuple[int, int, float, float], ...] = (
        (200, 128, 0.40, 9.9),
        (512, 512, 0.30, 0.80),
        (4_096, 2_048, 0.25, 0.80),
    )
    chunk_share: float = 0.25
    level: int = 3


def _repeats(w: W.Words) -> np.ndarray:
    """Of each text: words in windows of five found twice or more in it."""
    at, value = W.windows(w, WINDOW)
    if not len(at):
        return np.zeros(w.last - w.first, np.int64)
    doc = w.doc[at]
    order = np.lexsort((value, doc))
    same = (value[order][1:] == value[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(covered, at[twice], 1)
    np.add.at(covered, at[twice] + WINDOW, -1)
    inside = np.cumsum(covered[:-1]) > 0
    return np.bincount(w.doc[inside], minlength=w.last - w.first)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def _per_text(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[at[1:]] - total[at[:-1]]


def _reached(lines: tuple[tuple, ...], n: int) -> tuple | None:
    return next((x[1:] for x in reversed(lines) if n >= x[0]), None)


def _bands(text: bytes, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, int, bool]:
    """Whole ratio, chunks outside their limits, verdict. Empty text has ratio 1."""
    n = len(text)
    if not n:
        return 1.0, 0, True
    ratio = len(packer.compress(text)) / n
    low, high = _reached(bands.whole, n) or (0.0, ratio)
    starts, outside = [], 0
    if chunk := _reached(bands.chunks, n):
        size, least, most = chunk
        starts = list(range(0, n - size + 1, size))
        if n % size:
            starts.append(max(0, n - size))
        for at in starts:
            packed = len(packer.compress(text[at : at + size]))
            outside += not least * size <= packed <= most * size
    return ratio, outside, low <= ratio <= high and outside <= bands.chunk_share * len(starts)


def measure(docs: DataFrame, keys: list[str], text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The counts, ratios and verdicts of every whole text, in one pass without shuffle.

    Returns ``keys`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    ratio, n_chunks_outside, base_failed, kept. Null and empty texts have no words, so
    they fail the base rules. Repeated rows and null keys are measured like others.
    """
    long = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema.fields]
        + [f"{c} long" for c in long]
        + ["ratio double", "n_chunks_outside long", "base_failed boolean", "kept boolean"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            found: list[list] = [[] for _ in range(9)]
            for w in W.slices(column):
                n = w.per_doc
                repeats = _repeats(w)
                lead = ~W.SPACE[w.bytes] & ((w.bytes & 0xC0) != 0x80)
                raw = w.bytes.tobytes()
                texts = [raw[a:b] for a, b in zip(w.text_at[:-1], w.text_at[1:], strict=True)]
                verdicts = [_bands(x, packer, bands) for x in texts]
                failed = (n < 10) | (100 * repeats > 20 * n)
                parts = (
                    n,
                    _per_text(lead, w.text_at),
                    _per_text(_SYMBOL[w.bytes], w.text_at),
                    [_dup_lines(x) for x in texts],
                    repeats,
                    [x[0] for x in verdicts],
                    [x[1] for x in verdicts],
                    failed,
                    ~failed & np.array([x[2] for x in verdicts], bool),
                )
                for have, part in zip(found, parts, strict=True):
                    have.extend(part)
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.bool_(), pa.bool_()]
            arrays = [pa.array(x, k) for x, k in zip(found, kinds, strict=True)]
            names = [*batch.schema.names[:-1], *long, "ratio", "n_chunks_outside", "base_failed", "kept"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=names)

    return docs.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)
