from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from citemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    return local_session(4, shuffle_partitions=4, **{"spark.sql.warehouse.dir": str(warehouse)})


def rows(df, *order):
    """Collected rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))


@pytest.fixture
def plan():
    """Text of a DataFrame's physical plan."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
