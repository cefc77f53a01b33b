"""Dense row numbers over groups of any size.

A plain ``row_number`` sends a whole group to one task. Here a group is cut
into blocks, rows are numbered inside their block, and the size of all earlier
blocks is added. Only block counts are ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citemill.shared import materialise

BLOCK_ROWS = 65536


def row_block(row_idx: Column) -> Column:
    """Block of a row number that is unique in its group."""
    return F.floor(row_idx / BLOCK_ROWS).cast("bigint")


def number_rows(
    df: DataFrame,
    groups: list[str],
    blocks: list[Column],
    order: list[Column],
    name: str = "rn",
    upto: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1, 2, ... n per group.

    ``blocks`` are ordered columns that cut a group into bounded pieces and
    agree with the row order; ``order`` sorts the rows of one block. ``df`` is
    read twice, so hand in a stored table when it is costly to compute. With
    ``upto`` only the first rows of a group remain, and blocks that lie behind
    them are dropped before anything is sorted.
    """
    keys = [f"_b{i}" for i in range(len(blocks))]
    keyed = df.select("*", *[b.alias(k) for b, k in zip(blocks, keys)])
    together = [*groups, *keys]
    before = Window.partitionBy(*groups).orderBy(*keys).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        keyed.groupBy(*together)
        .agg(F.count("*").alias("_n"))
        .select(*together, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    if upto is not None:
        offsets = offsets.where(F.col("_before") < upto)
    inside = Window.partitionBy(*together).orderBy(*order)
    numbered = (
        keyed.join(offsets, together)
        .withColumn(name, (F.row_number().over(inside) + F.col("_before")).cast("bigint"))
        .drop("_before", *keys)
    )
    return numbered if upto is None else numbered.where(F.col(name) <= upto)


def number_by_range(df: DataFrame, order: list[Column], name: str = "rn") -> DataFrame:
    """Add ``name`` = 1, 2, ... n over all rows in the given order, for columns of any type.

    The rows are dealt out by ranges of the order, whose limits are found from a
    sample, and stored; they are numbered inside their range, and the size of
    all earlier ranges is added.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.join(F.broadcast(offsets), "_range")  # one row per range
        .withColumn(name, (F.row_number().over(inside) + F.col("_before")).cast("bigint"))
        .drop("_range", "_before")
    )
