"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every text becomes an array of word hashes. Its fingerprints are the smallest
hash of ``K`` consecutive words in each run of ``WINDOW - K + 1`` such grams, so
two texts that share ``WINDOW`` words share a fingerprint: no window is missed.
Fingerprints of documents meet those of the benchmark; only documents with a
common fingerprint are extended, that is, all their windows are compared with
all windows of the benchmark and the words they cover are counted. A benchmark
item of fewer words is one window as a whole; for each such length (at most
``WINDOW - 1`` of them) documents give all their grams instead.

Nothing larger than a benchmark that measures small is broadcast; a larger one
is joined by shuffle. Fingerprints leave the scan task as one partial flag per
document, so the shuffle holds a few bytes per document whatever its length.

Defined cases: a null or empty text has no words, is never contaminated and
(as an item) has no window; equal rows get equal results, once each; rows that
share an id but not the text are judged apart; a null id stays null; an empty
benchmark contaminates nothing; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citemill.llm.common import join_rows
from citemill.shared import fits_broadcast, materialise

WINDOW = 13
K = 6
# Contaminated when a word is hit and hits times this reach the words.
SHARE = 20

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once, also when ``f`` uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), f), 1)


def lower_ascii(word: Column) -> Column:
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Lower-cased words; a null text has none."""
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS)
    return F.transform(F.filter(parts, lambda w: w != ""), lower_ascii)


def word_hashes(text: Column) -> Column:
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS)
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(lower_ascii(w)))


def grams(hashes: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words, in order."""
    places = F.when(F.size(hashes) >= k, F.sequence(F.lit(1), F.size(hashes) - (k - 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(places, lambda i: F.xxhash64(F.slice(hashes, i, k)))


def fingerprints(hashes: Column) -> Column:
    """Distinct minima of the gram hashes over windows of ``WINDOW`` words."""
    width = WINDOW - K + 1

    def minima(g: Column) -> Column:
        places = F.when(F.size(g) >= width, F.sequence(F.lit(1), F.size(g) - (width - 1))).otherwise(
            F.array().cast("array<int>")
        )
        return F.array_distinct(F.transform(places, lambda i: F.array_min(F.slice(g, i, width))))

    return let(grams(hashes, K), minima)


def all_fingerprints(hashes: Column, short: list[int]) -> Column:
    """Fingerprints, and all grams of the lengths that short items have."""
    return F.array_union(fingerprints(hashes), F.concat(*(grams(hashes, n) for n in short))) if short else fingerprints(hashes)


def identified(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text`` and ``key``: equal for equal rows only (with ``id``)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("key", F.xxhash64(F.col("id").isNull(), F.col("text").isNull(), "text"))


def item_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item``, ``hashes`` of the words, for items with words."""
    rows = benchmark.select(F.col(id_col).alias("item"), word_hashes(F.col(text_col)).alias("hashes"))
    return rows.filter(F.size("hashes") > 0)


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def windows_of(hashes: Column, lengths: list[int]) -> Column:
    """All windows of the given lengths as (start, length, hash)."""

    def of(n: int) -> Column:
        places = F.when(F.size(hashes) >= n, F.sequence(F.lit(0), F.size(hashes) - n)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(
            places,
            lambda i: F.struct(
                i.alias("start"), F.lit(n).alias("length"), F.xxhash64(F.slice(hashes, i + 1, n)).alias("hash")
            ),
        )

    return F.concat(*map(of, lengths))


def scan(docs: DataFrame, items: DataFrame, short: list[int]) -> DataFrame:
    """Per distinct row: number of words, and whether a fingerprint of the benchmark occurs."""
    marks = items.select(F.explode_outer(let(F.col("hashes"), lambda h: all_fingerprints(h, short))).alias("mark"))
    marks = materialise(marks.filter(F.col("mark").isNotNull()).distinct(), "marks").withColumn("met", F.lit(True))
    seen = docs.select(
        "id",
        "key",
        let(
            word_hashes(F.col("text")),
            lambda h: F.struct(F.size(h).cast("long").alias("n"), all_fingerprints(h, short).alias("marks")),
        ).alias("s"),
    )
    each = seen.select("id", "key", F.col("s.n").alias("n_words"), F.col("s.marks").alias("marks"))
    each = each.select("id", "key", "n_words", F.explode_outer("marks").alias("mark"))
    return (
        each.join(small(marks), "mark", "left")
        .groupBy("id", "key")
        .agg(F.max("n_words").alias("n_words"), F.max(F.coalesce("met", F.lit(False))).alias("met"))
    )


def extend(docs: DataFrame, found: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """Hit words and items of the rows whose fingerprints met the benchmark."""
    listed = items.select(
        "item",
        F.explode_outer(
            F.when(F.size("hashes") < WINDOW, F.array(F.struct(
                F.size("hashes").alias("length"), F.xxhash64("hashes").alias("hash"),
            ))).otherwise(
                F.transform(
                    windows_of(F.col("hashes"), [WINDOW]),
                    lambda w: F.struct(w["length"].alias("length"), w["hash"].alias("hash")),
                )
            )
        ).alias("w"),
    )
    listed = materialise(listed.select("item", "w.length", "w.hash").distinct(), "windows")
    chosen = join_rows(docs, found.select("id", "key"), "left_semi", small=fits_broadcast(found))
    windows = chosen.dropDuplicates(["id", "key"]).select(
        "id",
        "key",
        F.explode_outer(let(word_hashes(F.col("text")), lambda h: windows_of(h, lengths))).alias("w"),
    )
    hits = windows.select("id", "key", "w.start", "w.length", "w.hash").join(
        small(listed.select("length", "hash", "item")), ["length", "hash"]
    )
    before = Window.partitionBy("id", "key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("id", "key", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    n_hit = (
        spans.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("id", "key")
        .agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "done"))).cast("long").alias("n_hit"))
    )
    items_of = (
        hits.select("id", "key", "item")
        .distinct()
        .groupBy("id", "key")
        .agg(F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items"))
    )
    return join_rows(n_hit, items_of)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per distinct (id, text): ``id, key, n_words, n_hit, items, contaminated``."""
    rows = identified(docs, id_col, text_col)
    items = materialise(item_windows(benchmark, item_col, item_text_col), "items")
    sizes = items.select(F.least(F.size("hashes"), F.lit(WINDOW)).alias("n")).distinct().collect()
    lengths = sorted(r["n"] for r in sizes)  # at most WINDOW values
    if not lengths:
        none = rows.groupBy("id", "key").agg(F.first(F.size(word_hashes(F.col("text")))).cast("long").alias("n_words"))
        none = none.withColumn("n_hit", F.lit(0).cast("long"))
        none = none.withColumn("items", F.array().cast("array<string>"))
        return none.withColumn("contaminated", F.lit(False))
    seen = materialise(scan(rows, items, [n for n in lengths if n < WINDOW]), "scanned")
    hits = extend(rows, materialise(seen.filter("met"), "met"), items, lengths)
    all_rows = join_rows(seen, hits, "left").select(
        "id",
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return all_rows.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns, one row per row of ``docs``."""
    found = contamination(docs, benchmark)
    rows = identified(docs, "doc_id", "text").select("id", "key")
    return join_rows(rows, found).select(
        F.col("id").cast("long").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows; all columns are kept."""
    found = materialise(contamination(docs, benchmark).filter("contaminated").select("id", "key"), "contaminated")
    text = F.col("text").cast("string")
    key = F.xxhash64(F.col("doc_id").isNull(), text.isNull(), text)
    return docs.join(small(found), F.col("doc_id").eqNullSafe(found.id) & (key == found.key), "left_anti")
