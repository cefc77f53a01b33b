"""Per-file cap, last-wins de-duplication and exact-size sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from citemill.operators.numbering import number_rows, row_block
from citemill.shared import materialise

# A sample of fewer rows may take a second reading.
SAMPLE_ROWS = 10_000


def cap_per_file(
    kept: DataFrame,
    max_lines: int = -1,
    exact_cap: bool = False,
    name: str = "file_rank",
    file: str = "file_no",
) -> DataFrame:
    """First rows of every file, in row order.

    A row is taken before the count is tested, so ``max_lines + 1`` rows
    remain; ``exact_cap=True`` leaves ``max_lines``. Zero or less is no cap.
    """
    if max_lines <= 0:
        return kept
    limit = max_lines if exact_cap else max_lines + 1
    return number_rows(
        kept, [file], [row_block(F.col("row_idx"))], [F.col("row_idx")], name, limit
    )


def last_wins(kept: DataFrame, file: str = "file_no") -> DataFrame:
    """Which row of each (file, pmid) survives, and where it stands in its file.

    The latest row gives the values, the earliest one the position. Both are
    plain numbers, so the aggregation is combined before the shuffle and wide
    columns never travel.
    """
    return kept.groupBy(file, "pmid").agg(
        F.max("row_idx").alias("row_idx"), F.min("row_idx").alias("first_idx")
    )


def exact_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """``int(fraction * n)`` rows without replacement, the same ones every time.

    Rows are ranked by an md5 of key and seed. ``df`` is read once: rows whose
    digest lies below a limit a little above ``fraction`` are stored, and all rows
    are counted on the way. The limit leaves ten standard deviations, so the sample
    is among the stored rows; where it is not (many rows with one key), ``df``
    is read again. The first four hex digits of the digest form 65,536 even blocks,
    so no task ranks more than its share.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    # A null key comes first.
    digest = F.coalesce(digest, F.lit(""))
    keyed = df.withColumn("_md5", digest)
    counted = Observation()
    counting = keyed.observe(counted, F.count(F.lit(1)).alias("n"))
    stored = materialise(counting.where(F.col("_md5") < sample_limit(fraction)), "sample")
    size = int(fraction * counted.get.get("n", 0))
    if stored.count() < size:
        stored = keyed
    ranked = number_rows(
        stored,
        [],
        [F.substring("_md5", 1, 4)],
        [F.col("_md5"), F.col(key)],
        "_rank",
        size,
    )
    return ranked.drop("_md5", "_rank")


def sample_limit(fraction: float) -> str:
    """The first hex digits below which the digests of a sample lie.

    Spread is that of ``SAMPLE_ROWS`` rows; more rows stray less. The digits are
    eight, of which "g" is above all.
    """
    limit = fraction + 10 * (max(0.0, fraction * (1 - fraction)) / SAMPLE_ROWS) ** 0.5
    return "g" if limit >= 1 else f"{int(limit * 16**8):08x}"
