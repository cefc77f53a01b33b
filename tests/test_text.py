from __future__ import annotations

import os
import random
import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citemill.functions.text import (
    REMOVED_PUNCTUATION,
    STRIPPED_SPACES,
    file_number,
    none_to_null,
    prefix_sums,
    preprocess_text,
    stem,
)
from citemill.operators.gates import eligible
from citemill.operators.tagger import normalise_surface


def python_clean(text: str) -> str:
    """The rule in words: strip, lower, newline/tab to space, drop punctuation."""
    text = text.strip().lower()
    return "".join(
        " " if c in "\n\t" else c
        for c in text
        if c not in string.punctuation or c in "()[]{}-%"
    )


EDGES = [
    "", "   ", "0123456789", "01234567890", " a\r\nb\tc ", "　x　", "\u001cx\u0085",
    "... lead", "[99mTc]-MIBI 5% {x}", "  y ", "İstanbul", "a  b", "'\"`\\^_|~",
    "ΑΣ. ΑΣΑ", "\x00z\x1f",
]


def test_constants():
    assert len(REMOVED_PUNCTUATION) == 24
    assert len(STRIPPED_SPACES) == 29
    assert all(not c.strip() for c in STRIPPED_SPACES)


def test_preprocess_edges(spark):
    df = spark.createDataFrame([(t,) for t in EDGES], "text string")
    got = {r["text"]: r["clean"] for r in df.select("text", preprocess_text(F.col("text")).alias("clean")).collect()}
    assert got == {t: python_clean(t) for t in EDGES}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=200))
def test_preprocess_any_text(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r["i"]: r["clean"] for r in df.select("i", preprocess_text(F.col("text")).alias("clean")).collect()}
    assert got == {i: python_clean(t) for i, t in enumerate(texts)}


def test_eligible_length_edges(spark):
    df = spark.createDataFrame([(None,), ("0123456789",), ("01234567890",), (" " * 11,)], "abstract string")
    assert sorted(r[0] for r in eligible(df).collect()) == [" " * 11, "01234567890"]


def test_prefix_sums(spark):
    rnd = random.Random(1)
    lists = [[], [5], *[[rnd.randint(0, 9) for _ in range(n)] for n in (31, 32, 33, 64, 65, 1000, 3000)]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<int>")
    got = {r["i"]: r["s"] for r in df.select("i", prefix_sums(F.col("x")).alias("s")).collect()}
    assert got == {i: [sum(x[:k]) for k in range(len(x))] for i, x in enumerate(lists)}


def test_file_names(spark):
    names = ["pubmed23n0001.xml.gz", "pubmed23n0001.xml", "a.xml.gz", "x/y/pubmed23n1234.xml.gz"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(file_number(F.col("n"))).collect()] == ["0001", "0001", "", "1234"]
    paths = ["/a/b/0001.json", "0002.parquet", "a.b/c", ".hidden", "x.tar.gz", "a..b", "d/..e.f"]
    df = spark.createDataFrame([(n,) for n in paths], "n string")
    expected = [os.path.splitext(os.path.basename(p))[0] for p in paths]
    assert [r[0] for r in df.select(stem(F.col("n"))).collect()] == expected


def test_none_text_is_null(spark):
    df = spark.createDataFrame([("None",), ("none",), (None,), ("x",)], "v string")
    assert [r[0] for r in df.select(none_to_null(F.col("v"))).collect()] == [None, "none", None, "x"]


def test_normalise_surface(spark):
    df = spark.createDataFrame([("[18F]-FDG,\n  Uptake",), ("IL-2's",)], "v string")
    assert [r[0] for r in df.select(normalise_surface(F.col("v"))).collect()] == ["[18f]-fdg uptake", "il-2s"]
