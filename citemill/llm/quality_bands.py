"""Quality rules by compression: zstandard ratios of whole documents and of fixed chunks.

Text that repeats itself compresses far better than prose of the same length,
keys and random strings far worse. What is usual depends on the length, so each
length class has its own band; a document is kept when its own ratio lies in the
band and at most half of its chunks lie outside theirs. The counting rules
(words, symbols, repeated lines and windows) go before.

Defined cases: a null or empty text has no words and fails the counting rules; a
null id stays null; rows with equal ids are judged one by one; an empty table
gives an empty result; other columns are not read. Every text is read whole, in
one pass without a shuffle; memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.llm.common import SPACES, Words, as_bytes, covered, free_name, map_arrow, per_text

LEVEL = 3
CHUNK_BYTES = 4096
# Ratio = bytes / compressed bytes. Each class: up to so many bytes, lowest and
# highest ratio of ordinary text. Short texts carry the frame's own cost.
# The lowest ratios lie 0.01 to 0.03 above the most that random text reaches (words of
# 3-9 letters, 200 texts a class and alphabet), for the alphabets whose most is, with
# that, at least 5 % below the least of prose: the 3,409 texts labelled good in sf0.1
# (four languages) and pieces of English manuals and licences. Base64 goes from 500
# bytes on, lower-case alphanumerics from 1,300, a-z from 3,200, hex from 6,400. Below
# that they compress as well as prose does (300 bytes: hex 1.69, prose from 1.18).
BANDS = [
    (100, 0.0, 2.0),
    (200, 0.7, 3.0),
    (400, 0.9, 3.2),
    (500, 1.1, 3.6),
    (600, 1.28, 3.6),
    (800, 1.31, 3.6),
    (1000, 1.33, 4.2),
    (1300, 1.35, 4.2),
    (1600, 1.54, 4.2),
    (2200, 1.56, 4.8),
    (3200, 1.57, 4.8),
    (4600, 1.72, 5.4),
    (6400, 1.73, 5.4),
    (12800, 1.93, 6.0),
    (20000, 1.98, 6.6),
    (float("inf"), 2.0, 6.6),
]
BAD_CHUNK_SHARE = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

# Bytes that begin a code point of a word.
WORD_CHARS = ~SPACES & ((np.arange(256) & 0xC0) != 0x80)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)


def in_band(n_bytes: int, ratio: float, bands=BANDS) -> bool:
    _, low, high = next(b for b in bands if n_bytes <= b[0])
    return low <= ratio <= high


def chunk_sizes(n: int, size: int = CHUNK_BYTES) -> list[tuple[int, int]]:
    """Fixed chunks; a rest of under half a chunk joins the chunk before it."""
    cuts = list(range(0, n, size))
    if len(cuts) > 1 and n - cuts[-1] < size // 2:
        cuts.pop()
    return list(zip(cuts, [*cuts[1:], n]))


def bands_of(text: bytes, compressor, bands=BANDS, size: int = CHUNK_BYTES) -> tuple[float, int, int]:
    """Ratio of the whole text, number of chunks, number of chunks outside their band."""
    if not text:
        return 0.0, 0, 0
    ratio = len(text) / len(compressor.compress(text))
    cuts = chunk_sizes(len(text), size)
    if len(cuts) == 1:
        return ratio, 1, int(not in_band(len(text), ratio, bands))
    view = memoryview(text)
    bad = sum(not in_band(b - a, (b - a) / len(compressor.compress(view[a:b])), bands) for a, b in cuts)
    return ratio, len(cuts), bad


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in a window found at least twice in that text."""
    grams, first = words.grams(window)
    keyed = grams ^ (words.text[first].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(keyed, kind="stable")
    ranked = keyed[order]
    same = np.zeros(len(ranked) + 1, dtype=bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    twice = first[order[same[:-1] | same[1:]]]
    hit = covered(twice, window, len(words.starts))
    return np.bincount(words.text[hit], minlength=len(words.counts)).astype(np.int64)


def judge(texts: list[bytes], bands=BANDS) -> dict[str, np.ndarray]:
    words = Words(texts)
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    measured = [bands_of(t, compressor, bands) for t in texts]
    ratio = np.array([m[0] for m in measured], dtype=np.float64)
    n_chunks = np.array([m[1] for m in measured], dtype=np.int64)
    bad = np.array([m[2] for m in measured], dtype=np.int64)
    in_words = per_text(words, WORD_CHARS[words.data])
    repeats = repeated_words(words)
    failed = (words.counts < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words.counts)
    fits = np.array([bool(t) and in_band(len(t), r, bands) for t, r in zip(texts, ratio)], dtype=bool)
    return {
        "n_words": words.counts,
        "word_chars": in_words,
        "n_symbols": per_text(words, SYMBOLS[words.data]),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": ~failed & fits & (bad <= BAD_CHUNK_SHARE * n_chunks),
        "ratio": ratio,
        "n_chunks": n_chunks,
        "n_bad_chunks": bad,
    }


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands=BANDS) -> DataFrame:
    """One row per document: counts, ratios and the verdict."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = judge(_texts(batch), bands)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, found.values())], names=["doc_id", *found]
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    return map_arrow(rows, run, SCHEMA)


def keep(docs: DataFrame, text_col: str = "text", bands=BANDS) -> DataFrame:
    """The documents the rules keep, with all their columns."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept = judge(_texts(batch), bands)["kept"]
        yield batch.select(range(batch.num_columns - 1)).filter(pa.array(kept))

    rows = docs.select("*", as_bytes(text_col).alias(free_name(docs, "_text_bytes")))
    return map_arrow(rows, run, docs.schema)
