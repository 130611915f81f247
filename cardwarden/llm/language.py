"""Language identification by Bayesian fusion of text, markup, address and host.

The text's likelihood comes from hashed letter trigrams of every language, counted
over the whole corpus. How far a declared language or an address suffix can be
believed, and which languages a host prefers, is learned from the text posteriors by
grouped sums. All evidence is added up as logarithms.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm import words as W
from cardwarden.llm.columns import apart
from cardwarden.session import discard, stored

BUCKETS = 1 << 16
#: Text that is cut into trigrams at once.
SLICE_BYTES = 1 << 18
#: A declared tag is a language of the model from this many trigrams, however small its
#: share of the table.
LEAST_TRIGRAMS = 2000
#: Languages of the model, those with the most trigrams: what is collected and broadcast
#: has at most this many tables, 128 MB.
LANGUAGES = 256
#: Languages that a task counts at once; more are handed on in between.
HELD = 256
#: A text fits a language if its mean log-likelihood is no further below that of the
#: language's own texts than this, and so many standard errors.
MARGIN, ERRORS = 1.5, 2.0
#: Trigrams overlap, so the text's evidence counts by this factor.
TEMPER = 1 / 3
#: Rows' worth of trust in the level above: the domain for a host, all for a domain.
HOST_ROWS, DOMAIN_ROWS = 20.0, 20.0
SMOOTHING = 0.5
KEEP_FROM = 0.65

_FOLD = np.full(256, 0x20, np.uint64)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def _trigrams(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each trigram with a letter in its middle; texts stand in spaces."""
    letters = _FOLD[w.bytes]
    if not len(letters):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.diff(w.text_at)
    some = sizes > 0
    before, behind = np.roll(letters, 1), np.roll(letters, -1)
    before[w.text_at[:-1][some]] = 0x20
    behind[w.text_at[1:][some] - 1] = 0x20
    code = before << np.uint64(16) | letters << np.uint64(8) | behind
    use = letters != 0x20
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return doc[use], (W.mix(code[use]) >> np.uint64(48)).astype(np.int64)


@dataclass
class TextModel:
    """Log-likelihoods of the buckets, a row for each language, in order of tags.

    ``usual`` and ``spread`` are their mean and variance over a language's own trigrams.
    """

    languages: list[str]
    log: np.ndarray
    usual: np.ndarray
    spread: np.ndarray


def tag(declared: Column) -> Column:
    """The primary subtag in lower case; empty counts as undeclared."""
    first = F.lower(F.regexp_extract(F.trim(declared.cast("string")), "^([A-Za-z]+)", 1))
    return F.when(first != "", first)


_SCHEMA = "declared string, part binary"


def _counted(counts: dict[str, np.ndarray]) -> pa.RecordBatch:
    packed = [zlib.compress(x.tobytes(), 1) for x in counts.values()]
    columns = [pa.array(list(counts), pa.string()), pa.array(packed, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["declared", "part"])


def fit(rows: DataFrame) -> TextModel:
    """Trigram counts of every declared language over all ``rows`` (text, declared).

    Each task sums up its own; what meets is one table of fixed size per language with
    enough letters to learn from. All tables are merged on Spark; those of the
    ``LANGUAGES`` tags with the most trigrams, equal ones by name, are the model.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in W.released(batches):
            tags = batch.column(1).dictionary_encode()
            names = tags.dictionary.to_pylist()
            which = tags.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for w in W.slices(batch.column(0), limit=SLICE_BYTES):
                doc, bucket = _trigrams(w)
                tongue = which[w.first : w.last][doc]
                order = np.argsort(tongue, kind="stable")
                at = np.flatnonzero(np.diff(tongue[order], prepend=-1))
                for own in np.split(order, at)[1:]:
                    name = names[tongue[own[0]]]
                    if name not in held:
                        if len(held) == HELD:
                            yield _counted(held)
                            held.clear()
                        held[name] = np.zeros(BUCKETS, np.int64)
                    held[name] += np.bincount(bucket[own], minlength=BUCKETS)
        yield _counted(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, total = None, np.zeros(BUCKETS, np.int64)

        def learned() -> pa.RecordBatch:
            one = _counted({name: total} if total.sum() >= LEAST_TRIGRAMS else {})
            size = pa.array([total.sum()] * one.num_rows, pa.int64())
            return pa.RecordBatch.from_arrays([*one.columns, size], names=["declared", "part", "trigrams"])

        for batch in batches:
            for own, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != name:
                    yield learned()
                    name, total = own, np.zeros(BUCKETS, np.int64)
                total += np.frombuffer(zlib.decompress(part), np.int64)
        yield learned()

    parts = rows.where(F.col("declared").isNotNull()).select("text", "declared")
    parts = parts.mapInArrow(count, _SCHEMA).repartition("declared").sortWithinPartitions("declared")
    tables = stored(parts.mapInArrow(merge, f"{_SCHEMA}, trigrams long"), "languages")
    most = tables.orderBy(F.desc("trigrams"), "declared").select("declared").limit(LANGUAGES)
    chosen = tables.join(most, "declared").select("declared", "part").collect()
    discard(tables)
    found = {r.declared: np.frombuffer(zlib.decompress(bytes(r.part)), np.int64) for r in chosen}
    languages = sorted(found)
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    for own, name in zip(counts, languages, strict=True):
        own += found[name]
    share = counts / counts.sum(axis=1, keepdims=True)
    log = np.log(share)
    usual = (share * log).sum(axis=1)
    return TextModel(languages, log, usual, (share * log * log).sum(axis=1) - usual * usual)


def read_texts(rows: DataFrame, model: TextModel, carry: list[str]) -> DataFrame:
    """``carry`` and, of each text, trigrams, and for each language log-likelihood and fit."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    n = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        log = m.log
        for batch in W.released(batches):
            for w in W.slices(batch.column(len(carry)), limit=SLICE_BYTES):
                doc, bucket = _trigrams(w)
                size = w.last - w.first
                trigrams = np.bincount(doc, minlength=size)
                value = np.zeros((size, n))
                some = np.flatnonzero(trigrams)
                head = (np.cumsum(trigrams) - trigrams)[some]
                for i in range(n if len(some) else 0):
                    value[some, i] = np.add.reduceat(log[i][bucket], head)
                # Trigrams overlap, so a text has fewer independent ones than it has.
                number = np.maximum(1, trigrams)[:, None]
                allowed = MARGIN + ERRORS * np.sqrt(m.spread / (TEMPER * number))
                fits = value / number >= m.usual - allowed
                at = pa.array(np.arange(size + 1, dtype=np.int32) * n)
                columns = [x.slice(w.first, size) for x in batch.columns[: len(carry)]]
                columns.append(pa.array(trigrams, pa.int64()))
                columns.append(pa.ListArray.from_arrays(at, pa.array(value.reshape(-1))))
                columns.append(pa.ListArray.from_arrays(at, pa.array(fits.reshape(-1))))
                names = [*carry, "trigrams", "log", "fits"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    schema = f"{kept}, trigrams long, log array<double>, fits array<boolean>"
    return rows.select(*carry, "text").mapInArrow(run, schema)


def _posterior(log: Column) -> Column:
    """Softmax of an array."""
    top = F.array_max(log)
    weight = F.transform(log, lambda x: F.exp(x - top))
    total = F.aggregate(weight, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weight, lambda x: x / total)


def _sums(rows: DataFrame, key: list[str], name: str, n: int) -> DataFrame:
    """Posteriors summed by key, as an array column."""
    parts = [F.sum(F.col("p")[i]) for i in range(n)]
    grouped = rows.groupBy(*key).agg(F.array(*parts).alias(name))
    return grouped


def identify(
    docs: DataFrame,
    keys: list[str],
    text: Column,
    declared: Column,
    suffix: Column,
    host: Column,
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """``keys`` with language, posterior, text_language, declared, trigrams and kept.

    ``declared`` is the markup's language, ``suffix`` the address's, ``host`` a dotted
    name; each may be null and then says nothing. A host's prior is smoothed towards its
    domain's (the last two labels), and that towards the whole corpus's. A row's own
    text never counts as evidence for its own markup, address or host.

    A text without letters, null or empty, has no language and is rejected, as is a
    document of which no language reaches ``keep_from``. A text that does not fit the
    language found, or whose declared one has too few letters in the whole table to be
    learned or is beyond the ``LANGUAGES`` with the most, keeps its declared language, without a posterior; with none declared it is
    undetermined and rejected. Repeated rows get equal results. With no declared language
    in the whole table nothing can be learned and all are rejected. Work is by row and by grouped sums; a host with a third of all
    rows is summed before the shuffle.
    """
    carry = [*(f"k{i}" for i in range(len(keys))), "declared", "suffix", "host", "domain"]
    host = F.lower(host.cast("string"))
    rows = docs.select(
        *(F.col(c).alias(f"k{i}") for i, c in enumerate(keys)),
        text.alias("text"),
        tag(declared).alias("declared"),
        F.lower(suffix.cast("string")).alias("suffix"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+(?:\.[^.]+)?)$", 1).alias("domain"),
    )
    model = fit(rows)
    n = len(model.languages)
    names = F.array(*map(F.lit, model.languages)) if n else F.array(F.lit("und"))
    read = read_texts(rows, model, carry)
    read = stored(read.withColumn("p", _posterior(F.transform("log", lambda x: x * TEMPER))), "read")
    if not n:
        return read.select(
            *(F.col(f"k{i}").alias(c) for i, c in enumerate(keys)),
            F.when(F.col("trigrams") > 0, F.col("declared")).alias("language"),
            F.lit(None).cast("double").alias("posterior"),
            F.lit(None).cast("string").alias("text_language"),
            "declared",
            "trigrams",
            ((F.col("trigrams") > 0) & F.col("declared").isNotNull()).alias("kept"),
        )
    told = read.where(F.col("trigrams") > 0)
    whole = told.agg(F.array(*(F.sum(F.col("p")[i]) for i in range(n))).alias("s")).first()
    total = [x or 0.0 for x in whole.s]
    rowcount = sum(total)
    of_all = F.array(*(F.lit(float(x)) for x in total))

    joined = read
    for key, name in (("declared", "by_tag"), ("suffix", "by_suffix"), ("host", "by_host"), ("domain", "by_domain")):
        sums = _sums(told.where(F.col(key).isNotNull()), [key], name, n)
        joined = joined.join(sums, key, "left")

    own = F.when(F.col("trigrams") > 0, F.col("p")).otherwise(F.array_repeat(F.lit(0.0), n))

    def less(name: str) -> Column:
        """Sums without the row's own share."""
        return F.zip_with(F.col(name), own, lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def size(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)

    def believed(name: str) -> Column:
        """log P(tag or suffix | language)."""
        value = F.zip_with(
            less(name), of_all, lambda a, b: F.log((a + SMOOTHING) / (b + 2 * SMOOTHING))
        )
        return F.when(F.col(name).isNotNull(), value)

    level0 = F.transform(of_all, lambda x: (x + SMOOTHING) / (rowcount + n * SMOOTHING))

    def shrunk(name: str, above: Column, weight: float) -> Column:
        has = less(name)
        value = F.zip_with(has, above, lambda a, b: (a + weight * b) / (size(has) + weight))
        return F.when(F.col(name).isNotNull(), value).otherwise(above)

    joined = joined.withColumn("_domain", shrunk("by_domain", level0, DOMAIN_ROWS))
    joined = joined.withColumn("_host", shrunk("by_host", F.col("_domain"), HOST_ROWS))
    evidence = F.zip_with("log", F.col("_host"), lambda a, b: a * TEMPER + F.log(b))
    for name in ("by_tag", "by_suffix"):
        say = F.coalesce(believed(name), F.array_repeat(F.lit(0.0), n))
        evidence = F.zip_with(evidence, say, lambda a, b: a + b)
    joined = joined.withColumn("_fused", _posterior(evidence))
    best = F.array_max("_fused")
    which = F.array_position("_fused", best).cast("int")
    unknown = F.col("declared").isNotNull() & ~F.array_contains(names, F.col("declared"))
    found = F.element_at("fits", which) & ~unknown
    language = F.when(found, F.element_at(names, which)).otherwise(F.col("declared"))
    by_text = F.element_at(names, F.array_position("p", F.array_max("p")).cast("int"))
    some = F.col("trigrams") > 0
    return joined.select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(keys)),
        F.when(some, language).alias("language"),
        F.when(some & found, best).alias("posterior"),
        F.when(some, by_text).alias("text_language"),
        "declared",
        "trigrams",
        (some & F.when(found, best >= keep_from).otherwise(F.col("declared").isNotNull())).alias("kept"),
    )


def spoken(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    declared: str = "lang",
    host: str = "source",
) -> DataFrame:
    """``docs`` without the rejected rows, and with the identified language as declared.

    Rejected and relabelled rows are a small table beside the documents, joined by
    content. All other columns are kept as they are, whatever their names.
    """
    own, name = apart(docs)
    key = F.col(name[text])
    own = own.withColumns({"t1": F.xxhash64(key), "t2": F.xxhash64(F.lit(1), key)})
    keys = [name[doc_id], "t1", "t2", name[declared], name[host]]
    none = F.lit(None).cast("string")
    found = identify(own, keys, key, F.col(name[declared]), none, F.col(name[host]))
    found = found.select(*(F.col(c).alias(f"on{i}") for i, c in enumerate(keys)), "language", "kept")
    other = ~F.col("kept") | ~F.col("language").eqNullSafe(F.col("on3"))
    changed = stored(found.where(other).distinct(), "changed")
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"on{i}"))
    rows = own.join(changed, same, "left").where(F.coalesce("kept", F.lit(True)))
    rows = rows.withColumn(name[declared], F.coalesce("language", F.col(name[declared])))
    return rows.select(*name.values()).toDF(*docs.columns)
