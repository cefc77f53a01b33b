"""Catalog tables: create if absent, load with dense ids, insert-ignore."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citemill.operators.numbering import number_rows, row_block
from citemill.shared import lookup_join, materialise
from citemill.sources.article_parquet import row_key


def table_names(spark: SparkSession) -> list[str]:
    """Names of the tables in the current database."""
    return [t.name for t in spark.catalog.listTables() if not t.isTemporary]


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str | None = None,
    buckets: int = 0,
    key: str = "tab_id",
) -> bool:
    """Create an empty table; warn and do nothing when the name is taken.

    ``buckets`` > 0 stores it bucketed by ``key``, so that later joins and
    groupings on the key need no shuffle.
    """
    if spark.catalog.tableExists(name):
        warnings.warn(f"table {name} already exists and is not created", stacklevel=2)
        return False
    writer = spark.createDataFrame([], schema).write.format("parquet")
    if buckets > 0:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return True


def _buckets(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Num Buckets")
    found = rows.first()
    return int(found["data_type"]) if found else 0


def append_by_name(rows: DataFrame, name: str, key: str = "tab_id") -> None:
    """Append rows, matching columns by name; absent columns become null."""
    spark = rows.sparkSession
    have = set(rows.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in spark.table(name).schema.fields
    ]
    out = rows.select(*columns)
    buckets = _buckets(spark, name)
    writer = out.write
    if buckets > 0:
        # A bucket's rows come together, and a large bucket is cut into tasks of the
        # advisory size, so a load gives a bucket one file or a file per such piece.
        bucket = out.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
        writer = bucket.hint("rebalance", "_bucket").drop("_bucket").write.bucketBy(buckets, key).sortBy(key)
    writer.mode("append").format("parquet").saveAsTable(name)


def dense_ids(rows: DataFrame, start: int | Column = 0) -> DataFrame:
    """(file, row_idx, tab_id): ids without gaps, in file and row order."""
    row = row_key(rows)
    numbered = number_rows(
        rows.select(*row), [], [F.col(row[0]), row_block(F.col("row_idx"))],
        [F.col("row_idx")], "tab_id",
    )
    return numbered.withColumn("tab_id", F.col("tab_id") + start)


def with_ids(rows: DataFrame, start: int = 0) -> DataFrame:
    """Add ``tab_id`` to wide rows; only the narrow keys are numbered."""
    row = row_key(rows)
    ids = materialise(dense_ids(materialise(rows.select(*row), "rows"), start), "row-ids")
    return lookup_join(rows, ids, row, "inner", [])


def fill_table(kept: DataFrame, name: str, distinct_pmids: bool = False) -> bool:
    """Append kept articles to a table; warn and do nothing when it is absent.

    Ids continue after the highest one in the table. Repeated pmids stay unless
    ``distinct_pmids`` is set; then the first row of each pmid, by file and row,
    is loaded.
    """
    spark = kept.sparkSession
    if not spark.catalog.tableExists(name):
        warnings.warn(f"table {name} does not exist and is not filled", stacklevel=2)
        return False
    if distinct_pmids:
        row = row_key(kept)
        first = kept.groupBy("pmid").agg(F.min(F.struct(*row)).alias("first")).select("first.*")
        kept = lookup_join(kept, materialise(first, "first-rows"), row, "left_semi", [])
    highest = spark.table(name).agg(F.coalesce(F.max("tab_id"), F.lit(0))).first()[0]
    rows = with_ids(kept, highest)
    rows = rows.withColumn("clean_abstract", F.lit("")).withColumn("clean_title", F.lit(""))
    append_by_name(rows, name)
    return True


def insert_ignore(rows: DataFrame, name: str, key: str = "tab_id") -> bool:
    """Append the rows whose key is not in the table yet, one row per key.

    The new rows are stored first: they may come from a query on the same table.
    Of several new rows with one key the smallest, column by column, is taken.
    """
    spark = rows.sparkSession
    if not spark.catalog.tableExists(name):
        warnings.warn(f"table {name} does not exist and is not filled", stacklevel=2)
        return False
    # Dealt out anew: a join by the table's buckets would bring a bucket to one task.
    known = spark.table(name).select(key).repartition(key)
    fresh = rows.join(known.hint("merge"), key, "left_anti")
    fresh = materialise(fresh, "fresh-rows")
    repeated = materialise(fresh.groupBy(key).count().where("count > 1").select(key), "repeated-keys")
    if not repeated.isEmpty():
        one = lookup_join(fresh, repeated, [key], "left_semi", fresh.columns).groupBy(key).agg(
            F.min(F.struct(*[c for c in fresh.columns if c != key])).alias("r")
        )
        single = lookup_join(fresh, repeated, [key], "left_anti", fresh.columns)
        fresh = single.unionByName(one.select(key, "r.*"))
    append_by_name(fresh, name, key)
    return True
