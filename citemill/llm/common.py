"""What several operators share: reading tables, mapping texts in bounded pieces, hashing words.

Words here are runs of bytes other than ASCII white space, which for UTF-8 is
the same as ``[^\\x20\\x09-\\x0D]+`` over code points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citemill.shared import give_back, small_batches

# Texts are worked on in pieces of about this many bytes, so that the arrays of
# one step stay small; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_bytes(column: str | Column) -> Column:
    """A text column as UTF-8 bytes, the form the Arrow functions below read."""
    return (F.col(column) if isinstance(column, str) else column).cast("string").cast("binary")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def tidy(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``f`` for ``mapInArrow``, with its memory given back at the end of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``f`` over every Arrow batch; each batch is first cut into pieces of bounded text size.

    ``df`` must have its text, as bytes, in the last column.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield from f(piece)

    small_batches(df.sparkSession)
    return df.mapInArrow(tidy(run), schema)


def pieces(batch: pa.RecordBatch, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose last column holds at most ``limit`` bytes, or is one row."""
    if batch.num_rows == 0:
        return
    lengths = np.nan_to_num(pa.compute.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False))
    total = np.cumsum(lengths.astype(np.int64))
    start = 0
    while start < len(total):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        found = {}
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            found[name] = np.multiply.accumulate(steps, out=steps)
        if size > PIECE_BYTES + 1:  # for one very long word; not kept
            return found["up"], found["down"]
        _powers.update(found)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    edges = np.flatnonzero(np.diff(~SPACES[data], prepend=False, append=False))
    return edges[0::2], edges[1::2]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes (ordered, not overlapping)."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE_BYTES, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = powers(high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[data[low:high]] * up[:-1], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * _M2)


class Words:
    """The words of several texts: spans in ``data``, hashes, and the text each belongs to."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join(texts)
        if lower:
            joined = joined.lower()
        self.data = np.frombuffer(joined, dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        #: Where each text begins and ends in ``data``.
        self.text_starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        self.text_ends = self.text_starts + sizes
        self.starts, self.ends = word_spans(self.data)
        self.text = np.searchsorted(self.text_starts, self.starts, side="right") - 1
        self.hashes = hash_spans(self.data, self.starts, self.ends)
        self.counts = np.bincount(self.text, minlength=len(texts)).astype(np.int64)
        self.firsts = np.concatenate(([0], np.cumsum(self.counts)[:-1])).astype(np.int64)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words, and the index of the first word of each."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        first = np.flatnonzero(self.text[:n] == self.text[k - 1 :])
        total = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            total = total * _M1 + self.hashes[j : j + n]
        return mix(total[first]), first


def per_text(words: Words, flags: np.ndarray) -> np.ndarray:
    """How many bytes of each text have their flag set."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[words.text_ends] - sums[words.text_starts]


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``length`` that begins at one of ``starts``."""
    change = np.zeros(n + length + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change)[:n] > 0


def join_rows(left: DataFrame, right: DataFrame, how: str = "inner", small: bool = False) -> DataFrame:
    """Join on ``id`` (null equals null) and ``key``; the right side's pair is dropped."""
    other = right.withColumnsRenamed({"id": "_right_id", "key": "_right_key"})
    same = F.col("id").eqNullSafe(F.col("_right_id")) & (F.col("key") == F.col("_right_key"))
    out = left.join(F.broadcast(other) if small else other, same, how)
    return out if how in ("left_semi", "left_anti") else out.drop("_right_id", "_right_key")
