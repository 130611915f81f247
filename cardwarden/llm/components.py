"""Connected components of a link table, as repeated joins on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.session import discard, stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("b", "a"))


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches: columns node, component.

    ``links`` has two long columns, the ends of a link. Alternating steps tie every
    node's larger neighbours, then its smaller ones, to the smallest neighbour, until
    nothing moves; the rounds grow with the logarithm of the longest chain. Minima are
    aggregated before the shuffle, and each node's neighbours are joined and never
    gathered, so a hub with a third of all links is no single task. Null ends and
    self-links are left out; nodes without links are absent.
    """
    x, y = links.columns
    edges = (
        links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
        .where(F.col("a") > F.col("b"))
        .distinct()
    )
    edges = stored(edges, "links")
    state = None
    while True:
        before = edges
        near = _both(edges)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            near.where(F.col("b") > F.col("a"))
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = (
            large.join(small, "a")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("a"), F.col("m").alias("b")),
                        F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    )
                ).alias("e")
            )
            .select("e.a", "e.b")
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        edges = stored(edges, "links")
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            break
        state = now
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(ends.select("component", "component")).distinct()
