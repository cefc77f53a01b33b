"""Items of JSON lists of any size, read by many tasks.

A file that holds one list of lists is a single record to a JSON reader, and so
one task's work, whatever its size. Here it is read in pieces that end at a
closing bracket. Spark cuts the file into byte ranges as it does any text file,
and what a piece means follows from the state of the text before it: whether it
begins inside a string, and how many brackets are open. A piece changes that
state in a way that does not depend on other pieces, so the states are prefix
sums: within a byte range, then over the ranges of a file.

A bracket can't be escaped in JSON, so no escape runs over the end of a piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citemill.shared import lookup_join, materialise

RANGE = ["file", "start"]


def read_pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, start, id, value): the text between closing brackets, in order of start and id."""
    return spark.read.option("lineSep", "]").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def count_of(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def piece_states(pieces: DataFrame) -> DataFrame:
    """``pieces`` with what they change.

    ``flips``: 1 if the piece ends inside a string when it begins outside, and the
    other way round. ``change_out`` and ``change_in``: brackets opened, less the one
    that ends the piece, when it begins outside or inside a string.
    """
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    strings = r'"[^"]*+("|$)'
    out, within = F.col("_out"), F.col("_in")
    return (
        pieces.withColumn("_bare", bare)
        .withColumn("_out", F.regexp_replace("_bare", strings, ""))
        .withColumn("_in", F.regexp_replace(F.regexp_replace("_bare", r'^[^"]*+("|$)', ""), strings, ""))
        .withColumn("flips", count_of(F.col("_bare"), '"') % 2)
        .withColumn("change_out", count_of(out, "[") - (1 - F.col("flips")))
        .withColumn("change_in", count_of(within, "[") - F.col("flips"))
        .drop("_bare", "_out", "_in")
    )


def running(pieces: DataFrame) -> DataFrame:
    """Add the states within each byte range, for a range that begins outside (0) and inside (1) a string.

    ``inside0``: the piece begins inside a string; ``depth0``, ``depth1``: brackets
    open behind the piece, less those open before the range.
    """
    sofar = Window.partitionBy(*RANGE).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    inside = F.pmod(F.sum("flips").over(sofar) - F.col("flips"), F.lit(2))
    change = lambda begins: F.when(begins == 0, F.col("change_out")).otherwise(F.col("change_in"))
    return (
        piece_states(pieces)
        .withColumn("inside0", inside)
        .withColumn("depth0", F.sum(change(F.col("inside0"))).over(sofar))
        .withColumn("depth1", F.sum(change(1 - F.col("inside0"))).over(sofar))
        .drop("change_out", "change_in")
    )


def range_states(pieces: DataFrame) -> DataFrame:
    """(file, start, inside, depth): the state each byte range begins in."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    ranges = pieces.groupBy(*RANGE).agg(
        F.sum("flips").alias("flips"),
        F.max_by("depth0", "id").alias("depth0"),
        F.max_by("depth1", "id").alias("depth1"),
    )
    return (
        ranges.withColumn("inside", F.pmod(total("flips"), F.lit(2)))
        .withColumn("opened", F.when(F.col("inside") == 0, F.col("depth0")).otherwise(F.col("depth1")))
        .select(*RANGE, "inside", total("opened").alias("depth"))
    )


def list_items(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, item, value): the JSON text of the items, which are lists themselves, of each file's list.

    What follows the list in its file is ignored. A list that is not closed, or
    holds something else behind its last item, fails the job.
    """
    pieces = materialise(running(read_pieces(spark, paths)), "pieces")
    states = materialise(range_states(pieces), "range-states")
    pieces = lookup_join(pieces, states, RANGE, "inner", ["id"])
    first = F.col("inside") == 0
    pieces = pieces.withColumn("depth", F.col("depth") + F.when(first, F.col("depth0")).otherwise(F.col("depth1")))
    # Whether the bracket behind the piece stands outside of strings.
    outside = F.pmod(F.col("inside") + F.col("inside0") + F.col("flips"), F.lit(2)) == 0
    pieces = pieces.select(
        *RANGE, "id", "value", (outside & (F.col("depth") == 1)).cast("int").alias("closes"),
        (outside & (F.col("depth") <= 0)).alias("ends"),
    )

    place = F.struct("start", "id")
    ranges = pieces.groupBy(*RANGE).agg(
        F.sum("closes").alias("closed"), F.min(F.when(F.col("ends"), place)).alias("end")
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *RANGE, F.coalesce(F.sum("closed").over(before), F.lit(0)).alias("closed"),
        F.min("end").over(Window.partitionBy("file")).alias("end"),
    )
    pieces = lookup_join(pieces, materialise(ranges, "range-items"), RANGE, "inner", ["id"])
    unclosed = F.raise_error(F.concat(F.lit("unreadable JSON: unclosed list in "), F.col("file")))
    pieces = pieces.where(F.when(F.col("end").isNull(), unclosed.cast("boolean")).otherwise(place <= F.col("end")))
    earlier = Window.partitionBy(*RANGE).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    item = F.col("closed") + F.coalesce(F.sum("closes").over(earlier), F.lit(0))
    # One item's pieces come together: a few, by its own length.
    items = pieces.withColumn("item", item).groupBy("file", "item").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "id", "value"))), lambda p: p["value"]), "]").alias("text"),
        F.max("closes").alias("closes"),
    )
    opening = F.when(F.col("item") == 0, F.lit(r"^\s*\[")).otherwise(F.lit(r"^\s*,"))
    text = F.regexp_replace("text", opening, F.lit(""))
    rest = F.raise_error(F.concat(F.lit("unreadable JSON: "), F.substring("text", 1, 200)))
    # An array, since a filter could be put behind what reads the items.
    led = F.when(F.col("item") == 0, F.col("text").rlike(r"^\s*\[")).otherwise(F.col("text").rlike(r"^\s*,"))
    found = F.when((F.col("closes") == 1) & led, F.array(F.concat(text, F.lit("]")))).when(
        F.col("text").rlike(r"^\s*$"), F.array().cast("array<string>")
    ).otherwise(rest.cast("array<string>"))
    return items.select("file", "item", F.explode(found).alias("value"))
