"""Shared storage and size-checked joins.

Everything that has to be written between two jobs (a trained model, a list of
kept articles) goes to the folder the cluster names in ``spark.checkpoint.dir``
as an ordinary parquet table. Such a table survives the loss of any executor
and lets the next step read its size before choosing a join.
"""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
import warnings

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its measured size is at most this many bytes (about
# four times that as a hash table, which the driver builds); a session may set another limit.
BROADCAST_BYTES = 16 * 1024 * 1024
BROADCAST_SETTING = "spark.citemill.broadcastBytes"
# Number of slices a possibly hot key is spread over when a side is too big.
SALTS = 16

# Rows and bytes of an Arrow batch that a Python function gets.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20

_local_dirs: dict[str, str] = {}


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most ``BATCH_ROWS`` rows and ``BATCH_BYTES``, unless the session has its own limits.

    A row is a whole text here; the usual 10,000 rows are tens of megabytes in
    the JVM and again in Python, for every running task.
    """
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    if spark.conf.get(ARROW_BYTES, "67108864b") in ("67108864b", "67108864", "64m", "64MB", "-1"):
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def give_back() -> None:
    """Return memory that a finished task has freed to the system; workers live on for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc only
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    Taken from the session. Only a local-mode session without the setting (a
    test, a laptop) gets a temporary folder; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.conf.get("spark.master", "").startswith("local")
    if configured:
        if configured.startswith("file:") and not local:
            warnings.warn(f"{configured} must be mounted on every machine of the cluster", stacklevel=3)
        return configured.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="citemill-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one table below this application's part of the shared folder."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/citemill/{spark.conf.get('spark.app.id', 'local')}"


def clear_stored(spark: SparkSession) -> None:
    """Delete what this application has stored between its jobs.

    For the end of a job: tables that were read from there can't be read again.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, which cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame):
    """Rough size of one row: string payload plus a fixed cost per column."""
    total = F.lit(16 + 8 * len(df.columns))
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "string":
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind in ("array", "map", "struct", "variant"):
            total = total + F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0))
    return total


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Measure ``df`` and say whether every executor can hold a copy.

    A session that switched broadcasts off keeps them off.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().startswith("-"):
        return False
    if max_bytes is None:
        max_bytes = int(conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES)))
    size = df.agg(F.sum(row_bytes(df).cast("bigint")).alias("b")).first()["b"]
    return (size or 0) <= max_bytes


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str,
    spread_by: list[str],
    max_bytes: int | None = None,
) -> DataFrame:
    """Join a large table to a lookup table whose keys are unique.

    A lookup that measures small is broadcast, so ``big`` does not move.
    Otherwise both sides are shuffled on the key plus a salt: rows of ``big``
    that share one hot key (or a null key) go to ``SALTS`` tasks, and the lookup
    is repeated once per salt. The salt depends on the row alone, so a
    recomputed task sends every row to the same place again.
    """
    if fits_broadcast(small, max_bytes):
        return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how, spread_by)


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str, spread_by: list[str]
) -> DataFrame:
    """The shuffled half of :func:`lookup_join`.

    Both halves are told to be shuffled: Spark goes by the size of a stored file,
    and a small file may hold rows that are too many for the driver, the more so
    once they are repeated. Without ``spread_by`` (keys that ``big`` hardly repeats) there is no salt.
    """
    if not spread_by:
        return big.join(small.hint("merge"), on, how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated.hint("merge"), [*on, "_salt"], how).drop("_salt")
