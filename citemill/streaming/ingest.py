"""Incremental ingest and filtering with Structured Streaming.

Every job takes what has arrived since its last run and stops. Batches only
gate and score; the rules that look at a whole file (cap, last wins) are applied
when the result is read, over all batches, since a file's rows may arrive in
several part files. A batch that is retried overwrites its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citemill.plans.filter_corpus import Scorer, passing, selected
from citemill.shared import lookup_join, materialise
from citemill.sources.article_parquet import numbered, row_key
from citemill.sources.article_xml import (
    CORRUPT,
    check_files,
    flatten,
    flatten_deleted,
    list_files,
    reject_files,
    scan_deleted,
    scan_xml,
)


def run_available(stream: DataFrame, sink, checkpoint: str) -> None:
    """Feed everything new to ``sink(batch, batch_id)`` and return."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()


def filter_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    scorer: Scorer,
    files_per_batch: int = 1000,
) -> None:
    """Add the articles of new parquet files in ``source`` that pass both gates to ``sink``.

    :func:`read_filtered` gives the result. Files without their own numbering
    get it here, as in the batch reader.
    """
    stream = numbered(
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        row = row_key(batch)
        passed = passing(batch, scorer).drop("pmid")
        kept = lookup_join(batch, passed, row, "inner", [])
        kept.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    run_available(stream, keep, checkpoint)


def read_filtered(
    spark: SparkSession, sink: str, max_lines: int = -1, exact_cap: bool = False
) -> DataFrame:
    """Kept articles of all batches: the same as one batch job over all files."""
    passed = spark.read.parquet(sink).drop("batch")
    narrow = passed.select(*row_key(passed), "pmid", "class_value")
    return selected(passed.drop("class_value"), narrow, max_lines, exact_cap)


def parse_new_files(
    spark: SparkSession, source: str, sink: str, checkpoint: str, files_per_batch: int = 1000
) -> None:
    """Parse the article XML files that are new in ``source``.

    The batch's file list is bounded by ``files_per_batch``; the same files are
    checked for damage before their articles are written.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    _parse_available(scan_xml(reader, source), flatten, sink, checkpoint)


def withdraw_new_files(
    spark: SparkSession, source: str, sink: str, checkpoint: str, files_per_batch: int = 1000
) -> None:
    """List the withdrawn articles of the article XML files that are new in ``source``.

    A job beside :func:`parse_new_files`, with its own sink and checkpoint, since a
    file may list withdrawn articles and hold none. Rows have the columns of
    articles, of which only the pmid, ``delete`` and the file's are set.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    _parse_available(scan_deleted(reader, source), flatten_deleted, sink, checkpoint)


def _parse_available(stream: DataFrame, flat, sink: str, checkpoint: str) -> None:
    """Write what ``flat`` makes of the records of intact files, one folder per batch."""
    # Paths in columns are URIs; a reader takes them undone.
    undone = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))

    def parse(batch: DataFrame, batch_id: int) -> None:
        parsed = materialise(flat(batch), "parsed")
        paths = [r["p"] for r in parsed.select(undone.alias("p")).distinct().collect()]
        if paths:
            manifest = check_files(list_files(batch.sparkSession, paths))
            parsed = reject_files(parsed, manifest)
        else:
            parsed = parsed.drop(CORRUPT)
        parsed.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    run_available(stream, parse, checkpoint)
