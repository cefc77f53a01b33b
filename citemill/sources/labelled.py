"""Labelled examples: ``[text, {"cats": ...}]`` and ``[text, {"entities": ...}]``."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citemill.functions.text import surface
from citemill.sources.json_list import list_items, read_pieces
from citemill.sources.keyed_json import parsed


# Bytes of one written list.
LIST_BYTES = 64 << 20


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(text, body) of every example; ``body`` is the JSON text of its labels.

    Two layouts are read, told apart file by file: one pair per line, and one list
    of all pairs, of any size, over one line or several; what follows the list is
    ignored. Both are read by byte ranges. Text that can't be read fails the job.
    """
    # Only a list of lists has a list in front, whatever the spaces between.
    listed = F.col("value").rlike(r"^\s*\[\s*\[")
    first = read_pieces(spark, path).where("start = 0").groupBy("file").agg(
        F.min_by(listed, "id").alias("listed")
    )
    # One name per file, as Spark's own listing of the folder.
    heads = first.select(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file"), "listed").collect()
    of_kind = lambda kind: [re.sub(r"([\[\]{}*?\\])", r"\\\1", h["file"]) for h in heads if h["listed"] == kind]
    parts = []
    if lists := of_kind(True):
        parts.append(list_items(spark, lists).select("value"))
    if (lines := of_kind(False)) or not parts:
        parts.append(spark.read.text(lines or path).where(F.trim("value") != ""))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    pairs = rows.select(parsed(F.col("value"), F.from_json("value", "array<string>")).alias("p")).where(F.size("p") > 0)
    body = F.get("p", 1)
    return pairs.select(
        F.get("p", 0).alias("text"), parsed(F.to_json("p"), body).alias("body")
    )


def read_cats(spark: SparkSession, path: str) -> DataFrame:
    """(text, cats): category maps with booleans read as 1 and 0."""
    cats = F.from_json("body", "cats map<string,string>")["cats"]
    number = lambda _, v: F.when(v == "true", F.lit(1.0)).when(v == "false", F.lit(0.0)).otherwise(
        v.try_cast("double")
    )
    return read_pairs(spark, path).select("text", F.transform_values(cats, number).alias("cats"))


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """(text, entities): arrays of (start, end, label)."""
    found = F.from_json("body", "entities array<array<string>>")["entities"]
    span = lambda e: F.struct(
        F.get(e, 0).cast("int").alias("start"),
        F.get(e, 1).cast("int").alias("end"),
        F.get(e, 2).alias("label"),
    )
    return read_pairs(spark, path).select("text", F.transform(found, span).alias("entities"))


def entity_rows(examples: DataFrame, keys: list[str]) -> DataFrame:
    """One row per labelled span with its surface text."""
    spans = examples.select(*keys, "text", F.inline("entities"))
    return spans.select(
        *keys, "start", "end", "label",
        surface(F.col("text"), F.col("start"), F.col("end")).alias("surface"),
    )


def json_string(text: Column) -> Column:
    """A JSON string literal."""
    quoted = F.to_json(F.array(text))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def pair_lines(examples: DataFrame, label_column: str) -> DataFrame:
    """One ``[text, {label_column: ...}]`` line per example."""
    body = F.to_json(F.struct(label_column))
    pair = F.concat(F.lit("["), json_string(F.col("text")), F.lit(", "), body, F.lit("]"))
    return examples.select(pair.alias("value"))


def write_cats(examples: DataFrame, path: str) -> None:
    """Write (text, cats) examples, one pair per line."""
    pair_lines(examples.select("text", "cats"), "cats").write.text(path)


def write_cats_lists(examples: DataFrame, path: str, files: int) -> None:
    """Write (text, cats) examples as ``files`` files of one list each, or more if they exceed ``LIST_BYTES``.

    Each list is opened, filled and closed by the task that sorts its examples, so
    it is one task's work; many examples make more lists, not longer ones.
    """
    pairs = pair_lines(examples.select("text", "cats"), "cats")
    size = pairs.agg(F.sum(F.octet_length("value").cast("bigint"))).first()[0] or 0
    files = max(files, math.ceil(size / LIST_BYTES))
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(files)))
    number = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    entries = pairs.select("part", number.alias("n"), F.concat(F.when(number > 1, ", ").otherwise(""), "value").alias("value"))
    ends = [(0, "["), (2**31 - 1, "]")]
    brackets = examples.sparkSession.range(files).select(
        F.col("id").alias("part"), F.inline(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(v).alias("value")) for n, v in ends]))
    )
    rows = entries.unionByName(brackets).repartition(files, "part").sortWithinPartitions("part", "n")
    rows.select("part", "value").write.partitionBy("part").text(path)


def write_entities(examples: DataFrame, path: str) -> None:
    """Write (text, entities) examples, one pair per line; spans become lists."""
    as_lists = F.transform(
        "entities",
        lambda e: F.concat(
            F.lit("["), e["start"].cast("string"), F.lit(", "), e["end"].cast("string"),
            F.lit(", "), json_string(e["label"]), F.lit("]"),
        ),
    )
    body = F.concat(F.lit('{"entities": ['), F.array_join(as_lists, ", "), F.lit("]}"))
    pair = F.concat(F.lit("["), json_string(F.col("text")), F.lit(", "), body, F.lit("]"))
    examples.select(pair.alias("value")).write.text(path)
