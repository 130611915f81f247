"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, its expected number of copies. Among all rates that give
every source its target number of words and stay at or below ``CAP``, those with the
least relative entropy to the present mix are exponential in the document's size:
``min(CAP, exp(multiplier * size / mean size))`` with one multiplier for each source.
The multipliers solve a convex dual, by Newton steps over grouped sums. Rates are
then rounded to whole copies.

Documents of one source and size are alike to all of this, so the work after the
first pass is on cells (source, size, number of documents): a source has at most as
many cells as its longest text has words, however many documents it has.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.columns import apart
from cardwarden.session import stored

CAP = 3
WEIGHTS = (1, 2, 3)
SOURCE = ["_null", "_source"]
CELL = [*SOURCE, "_size"]
#: Relative error of the words that the rates must reach, and the most Newton steps.
TOLERANCE, STEPS = 1e-9, 60
#: Rounds that bring a source's rounded words closer to its target.
REPAIRS = 6
_IN_BUCKET = 4096


def n_words(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    return F.coalesce(F.size(found), F.lit(0)).cast("long")


def measured(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """``docs`` with _null, _source, _size and _hash, the order of choice in a cell."""
    return docs.withColumns(
        {
            "_null": F.col(source).isNull(),
            "_source": F.coalesce(F.col(source).cast("string"), F.lit("")),
            "_size": F.when(F.col(text).isNull(), 0).otherwise(n_words(F.col(text))).cast("long"),
            "_hash": F.xxhash64(doc_id, text),
        }
    )


def targets(cells: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Of each source: its words, documents, and target.

    Sources in order of code points, null last, take the weights in turn. All words
    are shared by weight; a target stops at ``CAP`` times its source's words and the
    excess is shared again. The order is a range partitioning, so there may be more
    sources than one task holds.
    """
    totals = cells.groupBy(*SOURCE).agg(
        F.sum(F.col("_size") * F.col("_n")).alias("_words"),
        F.sum(F.when(F.col("_size") > 0, F.col("_n")).otherwise(0)).alias("_docs"),
    )
    ranged = totals.repartitionByRange(*SOURCE).sortWithinPartitions(*SOURCE)
    ranged = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_count"))
        .withColumn("_before", F.coalesce(F.sum("_count").over(before), F.lit(0)))
    )
    rank = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    turn = F.element_at(
        F.array(*map(F.lit, weights)), (rank % len(weights)).cast("int") + 1
    ).cast("double")
    weighed = stored(
        ranged.withColumn("_part", part)
        .join(offsets, "_part")
        .select(*SOURCE, "_words", "_docs", turn.alias("_weight")),
        "weighed",
    )
    top = CAP * F.col("_words").cast("double")
    total = weighed.agg(F.sum("_words")).first()[0] or 0
    share, before_share = 0.0, -1.0
    while share != before_share:
        before_share = share
        above = F.col("_weight") * share > top
        capped, open_weight = weighed.agg(
            F.sum(F.when(above, top).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("_weight")))
        ).first()
        share = (total - capped) / open_weight if open_weight else share
    return weighed.withColumn("_target", F.least(F.col("_weight") * share, top))


def _rate(multiplier: Column) -> Column:
    z = F.col("_size") / F.col("_mean")
    return F.when(F.col("_full"), float(CAP)).otherwise(
        F.least(F.exp(F.least(multiplier * z, F.lit(math.log(CAP)))), F.lit(float(CAP)))
    )


def balance(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with _multiplier, _mean and _full (everything is taken CAP times).

    Newton steps of all sources at once; each step is one grouped sum over the cells.
    A root is kept between bounds, and a step that leaves them halves the distance.
    """
    words = F.col("_words").cast("double")
    state = sources.where(F.col("_words") > 0).select(
        *SOURCE,
        "_target",
        (words / F.col("_docs")).alias("_mean"),
        (F.col("_target") >= CAP * words).alias("_full"),
        F.log(F.col("_target") / words).alias("_multiplier"),
        F.lit(None).cast("double").alias("_low"),
        F.lit(None).cast("double").alias("_high"),
    )
    state = stored(state, "multipliers")
    now, low, high = F.col("_multiplier"), F.col("_low"), F.col("_high")
    for _ in range(STEPS):
        z = F.col("_size") / F.col("_mean")
        rated = cells.join(state, SOURCE).withColumn("_rate", _rate(now))
        mass = F.col("_n") * F.col("_size") * F.col("_rate")
        sums = rated.groupBy(*SOURCE).agg(
            F.sum(mass).alias("_has"),
            F.sum(F.when(F.col("_rate") < CAP, mass * z).otherwise(0.0)).alias("_slope"),
        )
        over = F.col("_has") - F.col("_target")
        near = F.col("_full") | (F.abs(over) <= TOLERANCE * F.col("_target"))
        newton = F.when(F.col("_slope") > 0, now - over / F.col("_slope"))
        middle = F.coalesce(
            (low + high) / 2, F.when(over > 0, now - 1 - F.abs(now)).otherwise(now + 1 + F.abs(now))
        )
        inside = (newton > F.coalesce(low, newton - 1)) & (newton < F.coalesce(high, newton + 1))
        bounded = (
            state.join(sums, SOURCE)
            .withColumn("_near", near)
            .withColumn("_low", F.when(over < 0, now).otherwise(low))
            .withColumn("_high", F.when(over > 0, now).otherwise(high))
        )
        state = bounded.withColumn(
            "_multiplier",
            F.when(F.col("_near"), now)
            .when(F.coalesce(inside, F.lit(False)), newton)
            .otherwise(middle),
        ).select(*state.columns[:8], "_near")
        state = stored(state, "multipliers")
        if not state.where(~F.col("_near")).head(1):
            break
    return state.select(*SOURCE, "_mean", "_full", F.round("_multiplier", 9).alias("_multiplier"), "_target")


def rounded(cells: DataFrame, balanced: DataFrame) -> DataFrame:
    """Cells with _copies, the whole copies of all their documents together.

    Running sums of the rates over a source's sizes are rounded, so neighbours make
    up for each other. Then, a few times, the one copy more or less that brings the
    source's words closest to its target is made.
    """
    running = Window.partitionBy(*SOURCE).orderBy("_size")
    to_here = F.floor(F.sum(F.col("_n") * F.col("_rate")).over(running) + 0.5)
    rated = cells.join(balanced, SOURCE).withColumn("_rate", _rate(F.col("_multiplier")))
    cells = rated.withColumn("_to", to_here).select(
        *CELL,
        "_n",
        "_rate",
        "_target",
        (F.col("_to") - F.coalesce(F.lag("_to").over(running), F.lit(0))).alias("_copies"),
    )
    cells = stored(cells, "cells")
    for _ in range(REPAIRS):
        missing = cells.groupBy(*SOURCE).agg(
            (F.first("_target") - F.sum(F.col("_size") * F.col("_copies"))).alias("_missing")
        )
        can = F.when(F.col("_missing") > 0, F.col("_copies") < CAP * F.col("_n")).otherwise(
            F.col("_copies") > 0
        )
        left = F.abs(F.abs("_missing") - F.col("_size"))
        best = (
            cells.join(missing, SOURCE)
            .where(can & (F.col("_size") > 0) & (left < F.abs("_missing")))
            .groupBy(*SOURCE)
            .agg(
                F.min(F.struct(left.alias("left"), "_size")).getField("_size").alias("_size"),
                F.first(F.signum("_missing").cast("long")).alias("_step"),
            )
        )
        best = stored(best, "repairs")
        if not best.head(1):
            break
        step = F.coalesce(F.col("_step"), F.lit(0))
        cells = cells.join(best, CELL, "left").withColumn("_copies", F.col("_copies") + step)
        cells = stored(cells.drop("_step"), "cells")
    return cells


def chosen(thin: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells with _each copies of every document and one more up to _upto in hash order.

    Where a cell's copies don't divide evenly, the hash at which the rest is used up
    is found exactly: counts by ranges of the hash name the range, and only its
    documents are ranked, so a cell with most of the rows is no single task.
    """
    copies = cells.withColumn("_each", F.floor(F.col("_copies") / F.col("_n")))
    copies = copies.withColumn("_rest", F.col("_copies") - F.col("_each") * F.col("_n"))
    uneven = copies.where(F.col("_rest") > 0).select(
        *CELL, "_rest", F.ceil(F.col("_n") / _IN_BUCKET).alias("_buckets")
    )
    unit = F.shiftright("_hash", 1).cast("double") / float(1 << 63) + 0.5
    rows = thin.join(uneven, CELL).select(
        *CELL, "_rest", "_hash", F.floor(unit * F.col("_buckets")).alias("_bucket")
    )
    order = Window.partitionBy(*CELL).orderBy("_bucket")
    counts = rows.groupBy(*CELL, "_rest", "_bucket").agg(F.count(F.lit(1)).alias("_count"))
    counts = counts.withColumn("_end", F.sum("_count").over(order))
    place = F.col("_rest") - F.col("_end") + F.col("_count")
    last = counts.where((place > 0) & (F.col("_rest") <= F.col("_end")))
    last = last.select(*CELL, "_bucket", place.alias("_place"))
    ranked = rows.join(last, [*CELL, "_bucket"]).withColumn(
        "_rank",
        F.row_number().over(Window.partitionBy(*CELL, "_bucket").orderBy("_hash")),
    )
    upto = ranked.where(F.col("_rank") == F.col("_place")).select(*CELL, F.col("_hash").alias("_upto"))
    return copies.join(upto, CELL, "left").select(*CELL, "_each", "_rate", "_upto")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Measured documents, their sources' targets and the copies of each cell.

    Join the first with the others by ``SOURCE`` and ``CELL``; ``copies`` is then the
    number of times that the mix takes a document. A null text and a text without
    words have size 0 and one copy, which is worth nothing. A null source is a source
    of its own. Rows equal in id and text are chosen together. An empty table gives
    empty tables. No column of ``docs`` but the three named is read.
    """
    thin = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")
    )
    thin = measured(thin, "doc_id", "source", "text")
    thin = stored(thin.select("doc_id", *CELL, "_hash"), "sized")
    cells = stored(thin.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    sources = stored(targets(cells, weights), "targets")
    copies = chosen(thin, rounded(cells, balance(cells.where(F.col("_size") > 0), sources)))
    return thin, sources, stored(copies, "copies")


def copies() -> Column:
    """Of a measured document joined with its cell."""
    more = F.coalesce((F.col("_hash") <= F.col("_upto")).cast("long"), F.lit(0))
    return F.when(F.col("_size") == 0, F.lit(1)).otherwise(F.col("_each") + more).cast("long")


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; see ``mix``.

    All columns are kept as they are, whatever their names. Texts are not shuffled
    unless the cells are too many to broadcast, which Spark decides by their size.
    """
    _, _, cells = mix(docs, doc_id, source, text)
    own, name = apart(docs)
    rows = measured(own, name[doc_id], name[source], name[text])
    rows = rows.join(cells, CELL, "left")
    rows = rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies().cast("int"))))
    return rows.select(*name.values()).toDF(*docs.columns)
