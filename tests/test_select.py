from __future__ import annotations

import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from citemill.operators import numbering, select
from citemill.operators.numbering import number_rows, row_block
from citemill.plans.filter_corpus import filter_articles
from citemill.shared import fits_broadcast, lookup_join, materialise, salted_join


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(numbering, "BLOCK_ROWS", 3)


def passed(spark):
    """Two files; the first one has most rows, with gaps in the row numbers."""
    data = [("0001", i * 2, str(i % 4)) for i in range(20)] + [("0002", i, "p") for i in range(4)]
    return spark.createDataFrame(data, "file_no string, row_idx long, pmid string")


@pytest.mark.parametrize("max_lines,exact,first,second", [
    (-1, False, 20, 4), (0, False, 20, 4), (2, False, 3, 3), (2, True, 2, 2), (7, False, 8, 4),
    (1000, False, 20, 4),
])
def test_cap_takes_one_more(spark, small_blocks, max_lines, exact, first, second):
    got = rows(select.cap_per_file(passed(spark), max_lines, exact).select("file_no", "row_idx"))
    expected = [("0001", i * 2) for i in range(first)] + [("0002", i) for i in range(second)]
    assert got == sorted(expected, key=lambda r: tuple(map(str, r)))


def test_numbers_are_dense_over_blocks(spark, small_blocks):
    numbered = number_rows(
        passed(spark), [], [F.col("file_no"), row_block(F.col("row_idx"))], [F.col("row_idx")]
    )
    got = [tuple(r) for r in numbered.orderBy("rn").select("rn", "file_no", "row_idx").collect()]
    order = [("0001", i * 2) for i in range(20)] + [("0002", i) for i in range(4)]
    assert got == [(n + 1, *key) for n, key in enumerate(order)]


def test_last_wins_keeps_first_position(spark):
    got = rows(select.last_wins(passed(spark)))
    assert ("0001", "0", 32, 0) in got and ("0002", "p", 3, 0) in got and len(got) == 5


def test_cap_counts_duplicates_before_dedup(spark):
    articles = spark.createDataFrame(
        [("0001", i, pmid, f"a long abstract {i}") for i, pmid in enumerate("aabbc")],
        "file_no string, row_idx long, pmid string, abstract string",
    )
    scorer = lambda docs: docs.withColumn("score", F.lit(0.9))
    kept = filter_articles(articles, scorer, max_lines=2)
    assert rows(kept.select("pmid", "row_idx")) == [("a", 1), ("b", 2)]


def test_gate_is_strict(spark):
    articles = spark.createDataFrame(
        [("1", 0, "a", "x" * 11), ("1", 1, "b", "y" * 11), ("1", 2, "c", "z" * 10)],
        "file_no string, row_idx long, pmid string, abstract string",
    )
    scorer = lambda docs: docs.withColumn("score", F.when(F.col("pmid") == "a", 0.5).otherwise(0.500001))
    assert rows(filter_articles(articles, scorer).select("pmid", "class_value")) == [("b", 0.500001)]


def test_sample_has_exact_size_and_repeats(spark):
    df = spark.range(1001).withColumnRenamed("id", "doc_id")
    one, two = (select.exact_sample(df, "doc_id", 0.3, seed=s) for s in (1, 1))
    other = select.exact_sample(df, "doc_id", 0.3, seed=2)
    ids = rows(one)
    assert len(ids) == 300 and ids == rows(two) and ids != rows(other)
    assert select.exact_sample(df, "doc_id", 0.0).count() == 0
    assert select.exact_sample(df, "doc_id", 1.0).count() == 1001


@pytest.mark.parametrize("fraction", [0.0, 0.01, 0.5, 0.97, 1.0])
@pytest.mark.parametrize("one_key", [False, True])
def test_sample_is_read_once(spark, fraction, one_key):
    """The rows of a full ranking, also where most rows share one key or have none."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    key = F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") % 3 == 1, 7) if one_key else F.col("id")
    df = spark.range(40_000).select(key.alias("doc_id"), "id")
    got = select.exact_sample(df.mapInArrow(count, df.schema), "doc_id", fraction, seed=3)
    digest = lambda k: "" if k is None else hashlib.md5(f"{k}:3".encode()).hexdigest()
    keys = sorted((digest(r["doc_id"]) for r in df.collect()))[: int(fraction * 40_000)]
    assert sorted(digest(r["doc_id"]) for r in got.collect()) == keys
    if not one_key:
        assert seen.value == 40_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    """A third of the rows share one key, some keys are null or unknown."""
    big = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
    )
    small = spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") * 2).alias("v"))
    small = small.unionByName(spark.createDataFrame([("hot", -1)], "k string, v long"))
    if how in ("left_semi", "left_anti"):
        small = small.select("k")
    assert rows(salted_join(big, small, ["k"], how, ["id"])) == rows(big.join(small, ["k"], how))


def test_broadcast_only_below_the_limit(spark, plan):
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(100).withColumnRenamed("id", "k").withColumn("v", F.lit("x" * 50))
    assert fits_broadcast(small, 100 * 100) and not fits_broadcast(small, 1000)
    assert "BroadcastHashJoin" in plan(lookup_join(big, small, ["k"], "inner", ["k"]))
    beyond = lookup_join(big, small, ["k"], "inner", ["k"], max_bytes=1000)
    assert "_salt" in plan(beyond) and beyond.count() == 100


@pytest.mark.parametrize("spread_by", [["id"], []])
def test_shuffled_joins_stay_shuffled(spark, plan, spread_by):
    """A stored table far below Spark's own limit, as repeated values make it."""
    big = spark.range(1000).select("id", (F.col("id") % 90).alias("k"))
    small = materialise(spark.range(80).select(F.col("id").alias("k"), F.lit("v").alias("v")), "small")
    joined = salted_join(big, small, ["k"], "inner", spread_by)
    assert "BroadcastHashJoin" not in plan(joined) and ("_salt" in plan(joined)) == bool(spread_by)
    assert rows(joined) == rows(big.join(small, ["k"]))
