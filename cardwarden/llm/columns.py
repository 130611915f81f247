"""A caller's columns, kept out of the way of an operator's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns c0, c1, ..., and the new name of each old one."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def keys(doc_id: str, text: str) -> dict[str, Column]:
    """A hash of the id and two of the text, which name a row's content; never null."""
    return {
        "k0": F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id)),
        "k1": F.xxhash64(text),
        "k2": F.xxhash64(F.lit(1), F.col(text)),
    }


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, keys and text of every row."""
    found = (column.alias(name) for name, column in keys(doc_id, text).items())
    return docs.select(F.col(doc_id).alias("doc_id"), *found, F.col(text).alias("text"))
