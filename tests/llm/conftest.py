from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " id long, key string, n int, cls string, root string, _key int, bucket int"
)


def frame(spark, texts):
    """Documents with null columns and columns whose names operators use inside."""
    rows = [
        (i, t, None if (i or 0) % 3 == 0 else "en", None, None if t is None else len(t), 7, "k", 1, "c", "r", 2, 3)
        for i, t in texts
    ]
    return spark.createDataFrame(rows, SCHEMA)


PROSE = (
    "the quick brown fox jumps over a lazy dog while seven wizards mix strange potions under old bridges and"
    " nobody in town remembers who lit the lamps along that narrow road last winter when snow fell early"
)
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "word"),
    (5, PROSE),
    (5, PROSE),
    (5, PROSE + " but differently"),
    (None, PROSE),
    (None, None),
    (6, "ÄÖ é ü 日本語 " * 30),
    (7, "x" * 5000),
    (8, "On " * 3000),
    (9, PROSE.upper()),
    (10, "a\x0b\x0cb\rc\x85d　e\x1cf"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def sample(spark):
    """Real documents: all of the smallest table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def got(df, *columns):
    """Rows as sorted tuples; nulls sort as text."""
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
