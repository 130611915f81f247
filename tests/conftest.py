from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from cardwarden.operators.skew import SkewPolicy  # noqa: E402
from cardwarden.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def all_hot():
    """A policy under which every key with 3 rows takes the way of large keys."""
    return SkewPolicy(hot_rows=3, sample_fraction=1.0)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
