"""Article parquet datasets and resumable outputs.

A filtered output folder holds two datasets: ``kept`` (the articles, one
sub-folder per run) and ``files`` (which files a run has finished). A run
counts once its rows in ``files`` are there; rows of a run that died earlier
are never read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citemill.functions.text import stem
from citemill.shared import lookup_join

DONE = "file string, run string"


def file_key(df: DataFrame) -> str:
    """The column that identifies a row's file: its full path.

    Rows that carry a file number of their own and no path are identified by
    that number; it must then be unique among their files.
    """
    return "file_path" if "file_path" in df.columns else "file_no"


def row_key(df: DataFrame) -> list[str]:
    """The columns that identify a row."""
    return [file_key(df), "row_idx"]


def read_article_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Articles of a parquet folder, sub-folders included (see :func:`numbered`)."""
    return numbered(spark.read.parquet(path))


def numbered(df: DataFrame) -> DataFrame:
    """Rows of a parquet scan (or stream) with ``file_no`` and ``row_idx``.

    Files without their own numbering get it from the file name and from the
    position of the row in the file, and ``file_path`` beside it, since files of
    several folders may have equal names.
    """
    if {"file_no", "row_idx"} <= set(df.columns):
        return df
    extra = {
        "file_path": F.col("_metadata.file_path"),
        "file_no": stem(F.col("_metadata.file_name")),
        "row_idx": F.col("_metadata.row_index").cast("bigint"),
    }
    kept = [c for c in df.columns if c not in extra or c == "file_no"]
    return df.select(*kept, *[col.alias(name) for name, col in extra.items() if name not in kept])


def _read_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def finished_files(spark: SparkSession, output: str) -> DataFrame:
    """(file, run) of everything already filtered into ``output``."""
    done = _read_or_none(spark, f"{output}/files", DONE)
    return spark.createDataFrame([], DONE) if done is None else done


def remaining(inputs: DataFrame, done: DataFrame, spread_by: list[str]) -> DataFrame:
    """Rows of ``inputs`` whose file has no output yet.

    The list of finished files is broadcast if it measures small; otherwise the
    rows of a large file are spread by ``spread_by``.
    """
    key = file_key(inputs)
    files = done.select(F.col("file" if "file" in done.columns else key).alias(key)).distinct()
    return lookup_join(inputs, files, [key], "left_anti", spread_by)


def append_run(kept: DataFrame, files: DataFrame, output: str) -> str:
    """Write one run: first its rows, then the list of files it finished."""
    run = uuid.uuid4().hex
    kept.write.parquet(f"{output}/kept/run={run}")
    files.select(F.col(file_key(files)).alias("file"), F.lit(run).alias("run")).write.mode("append").parquet(
        f"{output}/files"
    )
    return run


def read_kept(spark: SparkSession, output: str) -> DataFrame:
    """Kept articles of all finished runs."""
    runs = finished_files(spark, output).select("run").distinct()
    kept = spark.read.option("basePath", f"{output}/kept").parquet(f"{output}/kept")
    return kept.join(runs, "run", "left_semi").drop("run")
