"""Text-to-type conversions that yield NULL, never an error, on bad input.

Spark 4 raises on a failed cast by default, so every conversion of raw text
goes through a ``try_`` variant and leaves the judgement to the quality rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_amount(text: Column) -> Column:
    """Decimal text to double, reading a comma as the decimal point.

    All commas become points, so a value with thousands separators
    (``1.234,56``) is not a number and gives NULL.
    """
    return F.translate(text, ",", ".").try_cast("double")


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Timestamp text to timestamp; ISO forms unless a pattern is given."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def sentinel_to_null(text: Column, sentinel: str = "N/A") -> Column:
    """Replace the source's "not applicable" marker by NULL."""
    return F.nullif(text, F.lit(sentinel))


def source_or_null(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """The column if the source has it, a typed NULL otherwise."""
    found = F.col(name).try_cast(dtype) if name in df.columns else F.lit(None).cast(dtype)
    return found.alias(name)
