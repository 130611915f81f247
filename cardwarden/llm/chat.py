"""Chat formatting with collapse of cumulative snapshots.

A logged conversation that is the beginning of a longer one is a snapshot of it. Every
turn has a hash of its place, role and text; the rolling combination of the turns up
to it names the prefix. A conversation whose whole hash is another's prefix is dropped
by an anti-join, and the maximal ones are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.session import stored

#: Turns whose hashes are combined in one window; longer conversations take two levels.
CHUNK = 1024
#: Turns of one rendered part.
PART = 256
# Fixed markers of the rendered form.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _turns(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    named = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    ).distinct()
    named = named.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    first = named.groupBy("conv_id").agg(F.min("turn").alias("first"))
    placed = named.join(first, "conv_id").withColumn("pos", F.col("turn") - F.col("first"))
    parts = ("pos", F.col("role").isNull(), F.coalesce("role", F.lit("")))
    parts += (F.col("text").isNull(), F.coalesce("text", F.lit("")))
    return placed.select(
        "conv_id",
        "pos",
        "role",
        "text",
        F.xxhash64(*parts).alias("h1"),
        F.xxhash64(F.lit(1), *parts).alias("h2"),
    )


def _prefixes(turns: DataFrame) -> DataFrame:
    """Of each turn, the number and combined hashes of all turns up to its place.

    Hashes are combined in chunks first, so a very long conversation is many tasks.
    """
    thin = turns.groupBy("conv_id", "pos").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    thin = thin.withColumn("chunk", F.floor(F.col("pos") / CHUNK))
    order = Window.partitionBy("conv_id").orderBy("chunk")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    chunks = thin.groupBy("conv_id", "chunk").agg(
        F.sum("n").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    none = F.lit(0).cast("long")
    before = chunks.select(
        "conv_id",
        "chunk",
        F.coalesce(F.sum("n").over(earlier), none).alias("n0"),
        F.coalesce(F.bit_xor("h1").over(earlier), none).alias("a0"),
        F.coalesce(F.bit_xor("h2").over(earlier), none).alias("b0"),
    )
    inside = Window.partitionBy("conv_id", "chunk").orderBy("pos")
    rolled = thin.select(
        "conv_id",
        "chunk",
        F.sum("n").over(inside).alias("n"),
        F.bit_xor("h1").over(inside).alias("a"),
        F.bit_xor("h2").over(inside).alias("b"),
    )
    return rolled.join(before, ["conv_id", "chunk"]).select(
        "conv_id",
        (F.col("n") + F.col("n0")).alias("n"),
        F.col("a").bitwiseXOR(F.col("a0")).alias("a"),
        F.col("b").bitwiseXOR(F.col("b0")).alias("b"),
    )


def _safe(text: Column) -> Column:
    """Text in which no marker of the rendered form can be read."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def render(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv_id, part, n_turns, n_logged and text of every maximal conversation.

    Of equal conversations the smallest conv_id stays; ``n_logged`` counts them. Turns
    are in order of their number, counted from the conversation's first; several at one
    number come in order of role and text, and a snapshot has all of them. Repeated rows count once. Rows without a
    conversation or number are no turns. A null role is ``unknown``, a null text empty.
    Markers inside texts are broken up. A conversation is rendered in parts of
    ``PART`` turn numbers, so that its length needs no more memory. Only the four named
    columns are read.
    """
    turns = stored(_turns(rows, conv_id, turn, role, text), "turns")
    whole = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h1").alias("a"), F.bit_xor("h2").alias("b")
    )
    distinct = whole.groupBy("n", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_logged")
    )
    length = whole.select("conv_id", F.col("n").alias("of"))
    proper = _prefixes(turns).join(length, "conv_id").where(F.col("n") < F.col("of"))
    maximal = distinct.join(proper.select("n", "a", "b").distinct(), ["n", "a", "b"], "left_anti")
    said = F.concat(
        F.lit(BEGIN), _safe(F.coalesce("role", F.lit("unknown"))), F.lit("\n"),
        _safe(F.col("text")), F.lit(END), F.lit("\n"),
    )
    order = F.struct("pos", "role", "text", said.alias("said"))
    return (
        turns.join(maximal.select("conv_id", F.col("n").alias("n_turns"), "n_logged"), "conv_id")
        .groupBy("conv_id", F.floor(F.col("pos") / PART).alias("part"), "n_turns", "n_logged")
        .agg(F.array_join(F.sort_array(F.collect_list(order)).getField("said"), "").alias("text"))
        .select("conv_id", "part", "n_turns", "n_logged", "text")
    )
