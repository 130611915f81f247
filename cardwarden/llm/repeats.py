"""Suffix-array deduplication on sparse, content-selected suffixes.

Of all suffixes of all texts, those are retained that begin at a minimiser: the
smallest hash of ``GRAM`` words among the ``SPAN`` ones of a passage of ``LENGTH``
words. Equal passages choose the same place, so whatever repeats over ``LENGTH`` words
repeats a retained suffix, at a twentieth of all places. Suffixes that share their
first words are sorted and neighbours compared, at every alignment that the
extension to the left allows; runs of matching alignments are the maximal match,
extended left and right.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm import words as W
from cardwarden.llm.columns import apart, keyed
from cardwarden.session import stored

LENGTH = 50
GRAM = 10
SPAN = LENGTH - GRAM + 1
#: Suffixes of one gram that are sorted in one task; the rest goes to further tasks, and
#: the passages that are first in a task meet in grouped minima.
IN_TASK = 4096


def _minimisers(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every passage: its first word, its minimiser's word and hash, its own hash."""
    at, gram = W.windows(w, GRAM)
    whole, passage = W.windows(w, LENGTH)
    if not len(whole):
        return whole, whole, passage, passage
    # A passage's grams are consecutive in ``gram``, since they lie in one text.
    head = np.searchsorted(at, whole)
    best, where = gram[head], head.copy()
    for j in range(1, SPAN):
        other = gram[head + j]
        less = other < best
        best = np.where(less, other, best)
        where[less] = head[less] + j
    return whole, at[where], best, passage


def _lists(values: np.ndarray, doc: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    at = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


def _suffixes(keyed: DataFrame) -> DataFrame:
    """Of each text its number of words and the hashes at its minimisers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in W.slices(batch.column(3)):
                _, where, best, _ = _minimisers(w)
                where, first = np.unique(where, return_index=True)
                columns = [x.slice(w.first, w.last - w.first) for x in batch.columns[:3]]
                columns.append(pa.array(w.per_doc, pa.int64()))
                grams = W.signed(best[first])
                columns.append(_lists(grams, w.doc[where], w.last - w.first, pa.int64()))
                names = ["doc_id", "k1", "k2", "n_words", "grams"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, k1 long, k2 long, n_words long, grams array<long>"
    return keyed.select("doc_id", "k1", "k2", "text").mapInArrow(run, schema)


def _passages(texts: DataFrame) -> DataFrame:
    """Passages whose minimiser's gram is wanted, a row for each run at one suffix.

    ``texts`` has nid, text and grams, the wanted ones. A row has the gram, the
    first passage's word and the hashes of the passages from there on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted_by_row = batch.column(2)
            for w in W.slices(batch.column(1)):
                whole, where, best, passage = _minimisers(w)
                doc = w.doc[whole] if len(whole) else whole
                keep = np.zeros(len(whole), bool)
                edge = np.searchsorted(doc, np.arange(w.last - w.first + 1))
                for i in np.unique(doc):
                    own = slice(edge[i], edge[i + 1])
                    wanted = wanted_by_row[w.first + int(i)].values.to_numpy(zero_copy_only=False)
                    keep[own] = np.isin(W.signed(best[own]), wanted)
                whole, where, best, passage = (x[keep] for x in (whole, where, best, passage))
                if not len(whole):
                    continue
                doc = doc[keep]
                new = np.ones(len(whole), bool)
                new[1:] = (where[1:] != where[:-1]) | (whole[1:] != whole[:-1] + 1)
                head = np.flatnonzero(new)
                take = pa.array(w.first + doc[head])
                columns = [batch.column(0).take(take)]
                columns.append(pa.array(W.signed(best[head])))
                columns.append(pa.array(whole[head] - w.word_at[doc[head]], pa.int64()))
                run_of = np.cumsum(new) - 1
                columns.append(_lists(W.signed(passage), run_of, len(head), pa.int64()))
                names = ["nid", "gram", "at", "hashes"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "nid long, gram long, at long, hashes array<long>"
    return texts.select("nid", "text", "grams").mapInArrow(run, schema)


def _neighbours(rows: DataFrame) -> DataFrame:
    """Passages equal to an earlier one of the same group, with the first of them.

    A group has the suffixes of a gram, or a part of them if there are very many. Of a
    group's passages, sorted by content and then by place, those equal to their
    neighbour before are repeats; a row of the result has ``count`` consecutive ones.
    Of a gram in parts, each part's first passages follow with gram and value.
    """

    def repeats(table: pa.Table) -> pa.RecordBatch:
        lists = table["hashes"].combine_chunks()
        sizes, value = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
        names = ("group", "nid", "gram", "at")
        group, nid, gram, at = (np.repeat(table[c].to_numpy(), sizes) for c in names)
        parted = np.repeat(table["parts"].to_numpy() > 1, sizes)
        at = at + np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = np.lexsort((at, nid, value, gram, group))
        group, nid, gram, at, value, parted = (
            x[order] for x in (group, nid, gram, at, value, parted)
        )
        new = np.ones(len(at), bool)
        new[1:] = (value[1:] != value[:-1]) | (gram[1:] != gram[:-1]) | (group[1:] != group[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        again = np.flatnonzero(~new)
        again = again[np.lexsort((at[again], nid[again]))]
        n, a, n0, a0 = nid[again], at[again], nid[first][again], at[first][again]
        head = np.ones(len(a), bool)
        head[1:] = (n[1:] != n[:-1]) | (a[1:] != a[:-1] + 1)
        head[1:] |= (n0[1:] != n0[:-1]) | (a0[1:] != a0[:-1] + 1)
        count = np.diff(np.append(np.flatnonzero(head), len(a)))
        open_ = np.flatnonzero(new & parted)
        runs, firsts = int(head.sum()), len(open_)
        none = pa.nulls(firsts, pa.int64())
        unset = pa.nulls(runs, pa.int64())

        def both(x: np.ndarray | pa.Array, y: np.ndarray | pa.Array) -> pa.Array:
            return pa.concat_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())])

        columns = [
            both(n[head], nid[open_]),
            both(a[head], at[open_]),
            both(count, np.ones(firsts, np.int64)),
            both(n0[head], none),
            both(a0[head], none),
            both(unset, gram[open_]),
            both(unset, value[open_]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[*_RUN, "gram", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column(0).to_numpy()
            whole = int(np.searchsorted(group, group[-1]))  # rows of groups that end here
            if whole or (held and held[-1].column(0)[0].as_py() != group[0]):
                yield repeats(pa.Table.from_batches([*held, batch.slice(0, whole)]))
                held = []
            held.append(batch.slice(whole))
        if held:
            yield repeats(pa.Table.from_batches(held))

    part = F.pmod(F.xxhash64("nid"), F.col("parts"))
    grouped = rows.withColumn("group", F.xxhash64("gram", part))
    grouped = grouped.select("group", "nid", "gram", "at", "hashes", "parts").repartition("group")
    schema = ", ".join(f"{c} long" for c in [*_RUN, "gram", "value"])
    return grouped.sortWithinPartitions("group").mapInArrow(run, schema)


_RUN = ["nid", "at", "count", "nid0", "at0"]


def _across(firsts: DataFrame) -> DataFrame:
    """Repeats among the first passages of a gram's parts, by grouped minima."""
    first = firsts.groupBy("gram", "value").agg(
        F.min(F.struct("nid", "at")).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    first = first.where(F.col("rows") > 1).drop("rows")
    later = (F.col("nid") != F.col("first.nid")) | (F.col("at") != F.col("first.at"))
    found = firsts.join(first, ["gram", "value"]).where(later)
    return found.select("nid", "at", "count", "first.nid", "first.at").toDF(*_RUN)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The spans of words that occur earlier, by id and place, over ``LENGTH`` words or more.

    A span is a longest run of words all of which lie in passages of ``LENGTH`` words
    that have an equal one before them, in a document of a smaller id or earlier in the
    same one. Returns doc_id, k1, k2 (hashes of the text), start and n_words of the
    span, text_words (of the whole text), and first_doc_id, first_start: where the
    span's first passage occurs first. The first occurrence of a passage is no span.

    Equal texts are one suffix; copies are spans from end to end. Null and empty texts
    and texts under ``LENGTH`` words have no spans. Rows without an id come before all
    others; rows equal in id and text are one document. Only the two named columns are
    read. A passage copied into a third of all texts is compared in parts and not in
    one task. An empty table has no spans.
    """
    named = keyed(docs, doc_id, text)
    rows = stored(_suffixes(named), "suffixes").where(F.col("n_words") >= LENGTH)
    nodes = (
        rows.groupBy("k1", "k2")
        .agg(
            F.min(F.struct("doc_id", "k1", "k2")).alias("rep"),
            F.first("n_words").alias("n_words"),
            F.first("grams").alias("grams"),
        )
        .repartitionByRange("rep")
        .sortWithinPartitions("rep")
        .withColumn("nid", F.monotonically_increasing_id())  # in order of the ids
    )
    nodes = stored(nodes, "texts")
    grams = nodes.select("nid", F.explode("grams").alias("gram"))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("suffixes"))
    counts = stored(counts.where(F.col("suffixes") > 1), "grams")
    wanted = grams.join(counts, "gram").groupBy("nid").agg(F.collect_set("gram").alias("grams"))
    needed = nodes.select("nid", F.col("rep.doc_id").alias("r0"), "k1", "k2").join(wanted, "nid")
    same = named.doc_id.eqNullSafe(needed.r0) & (named.k1 == needed.k1) & (named.k2 == needed.k2)
    texts = named.join(needed, same).select("nid", "text", "grams").dropDuplicates(["nid"])
    passages = stored(_passages(texts), "passages")
    many = counts.where(F.col("suffixes") > IN_TASK).select(
        "gram", F.ceil(F.col("suffixes") / IN_TASK).alias("parts")
    )
    passages = passages.join(many, "gram", "left").withColumn(
        "parts", F.coalesce("parts", F.lit(1).cast("long"))
    )
    compared = stored(_neighbours(passages), "neighbours")
    across = stored(_across(compared.where(F.col("gram").isNotNull())), "across")
    found = compared.where(F.col("gram").isNull()).select(*_RUN).union(across)
    # A part's first passage may itself be a repeat of another part's.
    earlier = across.select(
        F.col("nid").alias("nid0"),
        F.col("at").alias("start0"),
        F.col("nid0").alias("nid1"),
        F.col("at0").alias("start1"),
    )
    spans = _spans(found).join(earlier, ["nid0", "start0"], "left")
    spans = spans.select(
        "nid",
        "start",
        "n_words",
        F.coalesce("nid1", "nid0").alias("nid0"),
        F.coalesce("start1", "start0").alias("start0"),
    )
    spans = stored(spans, "spans")

    ids = nodes.select(F.col("nid").alias("nid0"), F.col("rep.doc_id").alias("first_doc_id"))
    of = nodes.select("nid", F.col("rep.doc_id").alias("doc_id"), "k1", "k2", "n_words")
    own = spans.join(of.withColumnRenamed("n_words", "text_words"), "nid")
    head = spans.where(F.col("start") == 0).select("nid", "nid0", "start0")
    begun = of.select("nid", F.col("doc_id").alias("r0"), "k1", "k2").join(head, "nid", "left")
    copies = (
        rows.select("doc_id", "k1", "k2", "n_words")
        .join(begun, ["k1", "k2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("r0")))
        .withColumns(
            {
                "start": F.lit(0).cast("long"),
                "text_words": F.col("n_words"),
                "nid0": F.coalesce("nid0", "nid"),
                "start0": F.coalesce("start0", F.lit(0)),
            }
        )
        .distinct()
    )
    columns = ["doc_id", "k1", "k2", "start", "n_words", "text_words", "nid0", "start0"]
    return (
        own.select(*columns)
        .union(copies.select(*columns))
        .join(ids, "nid0")
        .select(*columns[:6], "first_doc_id", F.col("start0").alias("first_start"))
    )


def _spans(found: DataFrame) -> DataFrame:
    """Runs of repeated passages, merged where they touch."""
    end = F.col("at") + F.col("count") - 1 + LENGTH
    order = Window.partitionBy("nid").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.col("at") > F.max("end").over(before), F.lit(True))
    return (
        found.withColumn("end", end)
        .withColumn("new", new.cast("long"))
        .withColumn("span", F.sum("new").over(order))
        .groupBy("nid", "span")
        .agg(
            F.min("at").alias("start"),
            (F.max("end") - F.min("at")).alias("n_words"),
            F.min(F.struct("at", "nid0", "at0")).alias("first"),
        )
        .select("nid", "start", "n_words", "first.nid0", F.col("first.at0").alias("start0"))
    )


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and the white space behind each of them."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, done = [], 0
    for start, n in sorted(spans):
        out.append(text[done : at[start]])
        done = at[start + n]
    return "".join([*out, text[done:]])


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated spans cut from the text; see ``find``.

    The first occurrence of every passage stays. A document that consists of spans
    alone goes; one without any is left as it is. Null texts stay null. All other
    columns are kept as they are, whatever their names.
    """
    spans = find(docs, doc_id, text)
    by_text = spans.groupBy("doc_id", "k1", "k2", "text_words").agg(
        F.collect_list("start").alias("starts"),
        F.collect_list("n_words").alias("lengths"),
        F.sum("n_words").alias("gone"),
    )
    own, name = apart(docs)
    key = F.col(name[text])
    own = own.withColumns(
        {"t1": F.xxhash64(key), "t2": F.xxhash64(F.lit(1), key), "id": F.col(name[doc_id])}
    )
    same = F.col("id").eqNullSafe(F.col("doc_id"))
    same = same & (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2"))

    @F.pandas_udf("string")
    def without(text: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.Series:
        rows = zip(text, starts, lengths, strict=True)
        return pd.Series([x if a is None else cut_text(x, list(zip(a, b, strict=True))) for x, a, b in rows])

    left = own.join(by_text, same, "left")
    left = left.where(F.coalesce(F.col("gone") < F.col("text_words"), F.lit(True)))
    left = left.withColumn(name[text], without(key, "starts", "lengths"))
    return left.select(*name.values()).toDF(*docs.columns)
