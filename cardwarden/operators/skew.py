"""Finding the few keys that hold too many rows for one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.session import stored


@dataclass(frozen=True)
class SkewPolicy:
    """When a key is too large for one task.

    ``hot_rows`` is what one task sorts comfortably. Every input is sampled: its size
    on disk says nothing about the rows of a key. A hot key has been seen at least
    twice in the sample.
    """

    hot_rows: int = 10_000_000
    sample_fraction: float = 0.0005

    def __post_init__(self) -> None:
        if self.hot_rows * self.sample_fraction < 2:
            raise ValueError("hot_rows * sample_fraction must be at least 2")


DEFAULT_SKEW = SkewPolicy()

HOT_KEY = "__hot_key"


def hot_keys(df: DataFrame, key: str, policy: SkewPolicy = DEFAULT_SKEW) -> DataFrame | None:
    """The keys estimated to hold ``hot_rows`` or more, or None if there are none.

    One pass over the key column alone. The list is a table in the shared scratch
    folder, so that every use sees the same keys, however many they are.
    """
    found = (
        df.select(F.col(key).alias(HOT_KEY))
        .sample(fraction=policy.sample_fraction, seed=11)
        .groupBy(HOT_KEY)
        .count()
        .filter(F.col("count") >= policy.hot_rows * policy.sample_fraction)
        .select(HOT_KEY)
    )
    found = stored(found, "hot_keys")
    return None if found.isEmpty() else found


def split_hot(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of all other keys, and the rows of the hot keys.

    Spark broadcasts the list if its size allows it.
    """
    is_hot = df[key].eqNullSafe(hot[HOT_KEY])
    return df.join(hot, is_hot, "left_anti"), df.join(hot, is_hot, "left_semi")
