"""Packing by power-of-two decomposition of each document's tokens."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT = 2048
END = 1
#: Distinct words that one Python worker remembers; beyond it the memory starts anew.
REMEMBERED = 1_000_000
#: Bits of a sequence id: the place in its task, then the task, then the length's power.
_PLACE_BITS, _TASK_BITS = 34, 24

# Runs of white space, which the tokenizer may take as one: no cut there. The other is
# the mark that the cuts are made at.
_MARK = "\x00"
_RUNS = re.compile(rf"\s\s|{_MARK}")


# Signs that a part may end with. After a letter they are a token run of their own.
_SIGNS = ".,;:!?%$#*&|)]}\""


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


_LETTERS = _byte_letters()


class _Parts(dict):
    """Numbers the parts of texts; new ones are gathered until they are encoded."""

    def __init__(self) -> None:
        self.count = 0
        self.new: list[tuple[int, str]] = []

    def add(self, part: str) -> int:
        """A number that is not looked up again."""
        self.new.append((self.count, part))
        self.count += 1
        return self.count - 1

    def __missing__(self, part: str) -> int:
        self[part] = number = self.add(part)
        return number


class _Encoder:
    """Token ids by the tokenizer file, each distinct part of a text encoded once.

    The tokenizer's own pattern never joins a letter, digit or sign with white space
    that follows it, so a text may be cut before every single space and line end and
    its parts encoded apart. Texts with longer runs of white space, or with a mark of the
    tokenizer such as its end mark, are encoded whole.
    """

    _open: dict[str, _Encoder] = {}

    @classmethod
    def of(cls, path: str) -> _Encoder:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        marks = [re.escape(k.content) for k in self.tokenizer.get_added_tokens_decoder().values()]
        # Marks are found in whole texts, as the tokenizer does it.
        self.whole = re.compile("|".join([_RUNS.pattern, *marks]))
        self.forget()

    def forget(self) -> None:
        self.parts = _Parts()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _room(self) -> None:
        for name, need in (("start", self.parts.count), ("length", self.parts.count)):
            have = getattr(self, name)
            if need > len(have):
                setattr(self, name, np.resize(have, max(2 * len(have), need)))

    def _learn(self) -> None:
        """Encode the new parts; a word with signs behind it is the word's ids and theirs."""
        new, known = self.parts.new, self.parts
        numbers, plain, joined = [], [], []
        for number, part in new:  # grows while it is read
            word = part.rstrip(_SIGNS) if part[-1:] in _SIGNS else part
            if len(word) < len(part) and word[-1:].isalpha() and part in known:
                joined.append((number, known[word], known[part[len(word) :]]))
            else:
                numbers.append(number)
                plain.append(part)
        self._room()
        self._keep(numbers, self._encode(plain))
        if joined:
            number, word, signs = np.array(joined, np.int64).T
            both = np.column_stack((word, signs)).reshape(-1)
            lengths = self.length[both].reshape(-1, 2).sum(axis=1)
            self._append(number, lengths, self._take(both))
        new.clear()

    def _encode(self, parts: list[str]) -> list[list[int]]:
        """Ids of each part; a space and Latin letters are one token run, merged directly."""
        ids: list[list[int] | None] = []
        merge = self.tokenizer.model.tokenize
        for x in parts:
            if x[:1] == " " and x[1:].isalpha() and max(x) < "\u0250":
                ids.append([k.id for k in merge(x.encode().decode("latin-1").translate(_LETTERS))])
            else:
                ids.append(None)
        rest = [x for x, have in zip(parts, ids, strict=True) if have is None]
        found = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        return [next(found).ids if have is None else have for have in ids]

    def _keep(self, numbers: list[int], ids: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
        self._append(np.array(numbers, np.int64), lengths, flat)

    def _append(self, numbers: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> None:
        old, self.used = self.used, self.used + len(flat)
        if self.used > len(self.ids):
            self.ids = np.resize(self.ids, max(2 * len(self.ids), self.used))
        self.ids[old : self.used] = flat
        self.start[numbers] = old + np.cumsum(lengths) - lengths
        self.length[numbers] = lengths

    def _take(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of all these parts, one after the other."""
        start, length = self.start[numbers], self.length[numbers]
        ends = np.cumsum(length)
        size = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(size) + np.repeat(start - ends + length, length)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, and ``END``."""
        if len(self.parts) > REMEMBERED:
            self.forget()
        look, which = self.parts.__getitem__, []
        for text in texts:
            if self.whole.search(text):
                which.append(np.array([self.parts.add(text)], np.int64))
            else:
                text = text.replace(" ", _MARK + " ").replace("\n", _MARK + "\n")
                parts = text.split(_MARK)
                which.append(np.fromiter(map(look, parts), np.int64, len(parts)))
        if self.parts.new:
            self._learn()
        end = np.full(1, END, np.uint32)
        return [np.concatenate((self._take(x), end)).astype("<u4", copy=False) for x in which]


def _blocks(column: pa.Array, limit: int = 500_000) -> Iterator[list[str]]:
    """The texts of a column, some at a time; null counts as empty."""
    block, held = [], 0
    for value in column:
        block.append(value.as_py() or "")
        held += len(block[-1])
        if held > limit:
            yield block
            block, held = [], 0
    if block:
        yield block


def piece_lengths(n: int, context: int = CONTEXT) -> list[int]:
    """``n`` as full contexts, then the powers of two of the rest, largest first."""
    full, rest = divmod(n, context)
    powers = [1 << b for b in range(context.bit_length() - 2, -1, -1) if rest >> b & 1]
    return [context] * full + powers


def pack(
    docs: DataFrame,
    tokenizer: str,
    keys: list[str],
    text: str = "text",
    ids: bool = True,
    context: int = CONTEXT,
) -> DataFrame:
    """Every token of every document in exactly one piece; a sequence is one piece.

    A document's ids (its text's, then id 1) are cut into whole contexts and the
    binary powers of what is left, so every sequence has a power of two ids of one
    document: nothing is padded and no sequence crosses documents. Sequences are
    bucketed by length: ``bucket`` is the power, and the leading bits of
    ``sequence_id``, so a range of ids is a bucket of equal lengths. The rest of the
    id is the task and the place in it; the same files give the same ids again.

    Returns ``keys``, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    bucket and, if asked for, ids. A null or empty text is id 1 alone; repeated rows
    are packed once each. Cut and encoding look at whole texts of any length.
    ``context`` must be a power of two.
    """
    if context < 1 or context & (context - 1):
        raise ValueError("context must be a power of two")
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema.fields]
        + ["start long", "length long", "ids_crc32 long", "doc_tokens long"]
        + ["sequence_id long", "offset long", "bucket int"]
        + ["ids array<int>"] * ids
    )
    fields = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Encoder.of(tokenizer)
        task = TaskContext.get().partitionId() << _PLACE_BITS
        places = [0] * context.bit_length()
        for batch in batches:
            row, found = [], [[] for _ in fields]
            kept: list[np.ndarray] = []

            def out(batch=batch, row=row, found=found, kept=kept) -> pa.RecordBatch:
                taken = pa.array(row, pa.int32())
                columns = [batch.column(i).take(taken) for i in range(batch.num_columns - 1)]
                columns += [pa.array(x, pa.int64()) for x in found[:-1]]
                columns.append(pa.array(found[-1], pa.int32()))
                names = [*batch.schema.names[:-1], *fields]
                if ids:
                    ends = np.concatenate(([0], np.cumsum([len(x) for x in kept])))
                    flat = np.concatenate([*kept, np.zeros(0, np.uint32)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
                    names.append("ids")
                return pa.RecordBatch.from_arrays(columns, names=names)

            held = 0
            texts = _blocks(batch.column(batch.num_columns - 1))
            for i, have in enumerate(x for block in texts for x in encode(block)):
                at = 0
                for n in piece_lengths(len(have), context):
                    part, power = have[at : at + n], n.bit_length() - 1
                    row.append(i)
                    values = (at, n, zlib.crc32(part), len(have))
                    name = (power << (_PLACE_BITS + _TASK_BITS)) | task | places[power]
                    for x, v in zip(found, (*values, name, 0, power), strict=True):
                        x.append(v)
                    places[power] += 1
                    if ids:
                        kept.append(part)
                    at += n
                held += len(have)
                if held > 4_000_000:  # a bounded result at a time
                    yield out()
                    for x in (row, *found, kept):
                        x.clear()
                    held = 0
            yield out()

    return docs.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)
