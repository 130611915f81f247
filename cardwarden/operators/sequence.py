"""Previous-row lookup within a key, safe for keys of any size.

``lag`` needs all rows of a key in one task, in order. That is right for almost
every key and wrong for one that holds a large part of the table. The few such
keys are found from a sample, and only their rows take a longer way:

1. range-partition by (key, order), which cuts a large key into ordered slices;
2. ``lag`` within each (key, slice);
3. ``lag`` once more over the slices' edge rows only, so that the first row of a
   slice finds the last row of the slice before it.

The sample decides only which way a key takes. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.operators.skew import DEFAULT_SKEW, SkewPolicy, hot_keys, split_hot

_SLICE, _HERE, _BEFORE, _LAST = "__slice", "__here", "__before", "__last"


def _lag_in_one_task(
    df: DataFrame, key: str, order: Sequence[str], previous: Mapping[str, Column]
) -> DataFrame:
    # A row without a key is a group of its own.
    alone = F.when(F.col(key).isNull(), F.col(order[-1]))
    window = Window.partitionBy(key, alone).orderBy(*order)
    return df.select("*", *[F.lag(c).over(window).alias(n) for n, c in previous.items()])


def _lag_across_slices(
    df: DataFrame, key: str, order: Sequence[str], previous: Mapping[str, Column]
) -> DataFrame:
    sliced = df.repartitionByRange(key, *order).select(
        "*",
        F.spark_partition_id().alias(_SLICE),
        F.struct(*[c.alias(n) for n, c in previous.items()]).alias(_HERE),
    )
    within = Window.partitionBy(key, _SLICE).orderBy(*order)
    stepped = sliced.select(
        "*",
        F.lag(_HERE).over(within).alias(_BEFORE),
        F.lead(F.lit(True)).over(within).isNull().alias(_LAST),
    )
    # A slice's first and last rows share one group per key, of at most two rows
    # per slice. All other rows stay in their slice's group and ignore this lag.
    first = F.col(_BEFORE).isNull()
    group = F.when(first | F.col(_LAST), F.lit(-1)).otherwise(F.col(_SLICE))
    edges = Window.partitionBy(key, group).orderBy(*order)
    before = F.when(first, F.lag(_HERE).over(edges)).otherwise(F.col(_BEFORE))
    return stepped.select(*df.columns, before.alias(_BEFORE)).select(
        *df.columns, *[F.col(f"{_BEFORE}.{name}").alias(name) for name in previous]
    )


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    previous: Mapping[str, Column],
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Add, per name, the expression's value on the row before within ``key``.

    ``order`` must end in a column that makes it total, so that the result does
    not depend on how the input is laid out. The first row of a key gets NULLs, and so
    does every row without a key.
    """
    hot = hot_keys(df.filter(F.col(key).isNotNull()), key, policy)
    if hot is None:
        return _lag_in_one_task(df, key, order, previous)
    rest, large = split_hot(df, key, hot)
    return _lag_in_one_task(rest, key, order, previous).unionByName(
        _lag_across_slices(large, key, order, previous)
    )
