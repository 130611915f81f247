from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from cardwarden.session import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    ship_package(spark)

    def build(rows, extra: str = ""):
        """Documents of (doc_id, text, lang, source); ``extra`` names more null columns."""
        full = [(*r, len(r[1] or "")) for r in (tuple(r) + (None,) * (4 - len(r)) for r in rows)]
        df = spark.createDataFrame(full, DOCS)
        for name in extra.split():
            df = df.selectExpr("*", f"cast(null as string) as `{name}`")
        return df

    return build


def prose(seed: int, n: int) -> str:
    """``n`` words that no other seed shares."""
    return " ".join(f"w{seed}x{i * i % 9973}" for i in range(n))
