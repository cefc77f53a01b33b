"""Substring removal by content-defined chunks.

A gear hash rolls over the bytes (each byte's code is added to the doubled hash,
so a byte is forgotten after 32 steps); a chunk ends where the hash has zeros in
its upper bits, not before ``SMALLEST`` and at the latest after ``LARGEST``
bytes. Chunk ends depend on the content alone, so an insertion moves only the
chunks around it. Chunks are compared by digest and length. A run of neighbouring
repeated chunks of at least ``RUN_BYTES`` is a repeat; shorter ones are everyday
phrases. A passage loses its first and last part of a chunk, so chunks are small:
of passages of 50 random words in two texts none is missed and 81 percent of the
bytes are flagged (chunks twice as large miss 2 to 4 percent and flag 70). Of a repeat the first occurrence, by id and place, stays.

Digests leave a text as an array, each once with its count, and are summed
before the shuffle. Only repeated digests go back to their texts, and only texts
that have some are read again.

Defined cases: a null text is empty, an empty text has no chunk; rows with equal
ids are separate texts; of rows equal in id and text all but one count as later
copies of the first; a null id comes after all others and stays null; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.llm.common import BYTE_CODES, as_bytes, hash_spans, join_rows, map_arrow
from citemill.llm.suffix_groups import identified, with_texts
from citemill.shared import fits_broadcast, materialise

SMALLEST = 8
LARGEST = 256
# So many upper bits must be zero: a cut every 2**CUT_BITS bytes on average.
CUT_BITS = 4
RUN_BYTES = 128
GEAR = (BYTE_CODES >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte. Doubling the reach five times covers its 32 bits."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        shifted = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += shifted
    return h


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text."""
    n = len(data)
    hits = (np.flatnonzero(gear_hashes(data) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()
    ends, start = [], 0
    for hit in [*hits, n]:
        while hit - start > LARGEST:
            start += LARGEST
            ends.append(start)
        if hit - start >= SMALLEST:
            ends.append(hit)
            start = hit
    if n and (not ends or ends[-1] < n):
        ends.append(n)
    return np.array(ends, dtype=np.int64)


def chunks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and digests of the chunks of a text."""
    data = np.frombuffer(text, dtype=np.uint8)
    ends = chunk_ends(data)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
    return starts, ends, hash_spans(data, starts, ends).view(np.int64)


def marks(rows: DataFrame) -> DataFrame:
    """Per text: its distinct (digest, length) and how often each occurs."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = ([], [], [])
        for text in batch.column(2).to_pylist():
            starts, ends, digests = chunks(text)
            sizes = ends - starts
            by = np.lexsort((sizes, digests))
            d, s = digests[by], sizes[by]
            new = np.ones(len(d), dtype=bool)
            new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
            at = np.flatnonzero(new)
            for column, values in zip(columns, (d[at], s[at], np.diff(np.append(at, len(d))))):
                column.append(values)
        kinds = [pa.list_(k) for k in (pa.int64(), pa.int32(), pa.int32())]
        arrays = [pa.array([v.astype(k.value_type.to_pandas_dtype()) for v in c], type=k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *arrays], names=["id", "key", "digests", "sizes", "times"]
        )

    return map_arrow(
        rows.select("id", "key", as_bytes("text").alias("text")),
        run,
        "id long, key long, digests array<long>, sizes array<int>, times array<int>",
    )


def shared_chunks(rows: DataFrame) -> DataFrame:
    """``id, key, flags``: per text its repeated chunks and whether the text holds the first of them."""
    marked = materialise(marks(rows), "chunks")
    each = marked.select("id", "key", F.explode(F.arrays_zip("digests", "sizes", "times")).alias("m")).select(
        "id", "key", F.col("m.digests").alias("digest"), F.col("m.sizes").alias("size"), F.col("m.times").alias("times")
    )
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    common = (
        each.groupBy("digest", "size")
        .agg(F.sum("times").alias("n"), F.min(place).alias("at"))
        .filter("n > 1")
        .select("digest", "size", F.col("at.id").alias("first_id"), F.col("at.key").alias("first_key"))
    )
    # Repeated digests grow with the texts, so they are joined by shuffle at every
    # size; a hot digest is a skewed partition, which adaptive execution splits.
    met = each.drop("times").join(materialise(common, "common"), ["digest", "size"])
    own = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key"))
    return (
        met.select("id", "key", F.struct("digest", "size", own.alias("own")).alias("f"))
        .groupBy("id", "key")
        .agg(F.collect_set("f").alias("flags"))  # rows equal in id and text count once
    )


def judge(text: bytes, flags: list[dict]) -> dict:
    """Counts, repeats and what is kept of one text."""
    starts, ends, digests = chunks(text)
    sizes = (ends - starts).tolist()
    known = {(f["digest"], f["size"]): f["own"] for f in flags}
    seen, repeated, later = set(), [], []
    for pair in zip(digests.tolist(), sizes):
        repeated.append(pair in known)
        later.append(pair in known and (not known[pair] or pair in seen))
        seen.add(pair)
    hit, gone = np.zeros(len(text), dtype=bool), np.zeros(len(text), dtype=bool)
    for flagged, marked in ((repeated, hit), (later, gone)):
        edges = np.flatnonzero(np.diff(np.array(flagged, dtype=bool), prepend=False, append=False))
        for a, b in zip(edges[0::2], edges[1::2]):
            if ends[b - 1] - starts[a] >= RUN_BYTES:
                marked[starts[a] : ends[b - 1]] = True
    spans = np.flatnonzero(np.diff(hit, prepend=False, append=False))
    kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
    return {
        "n_bytes": len(text),
        "n_chunks": len(sizes),
        "n_repeated_chunks": sum(repeated),
        "n_repeated_bytes": int(hit.sum()),
        "n_removed": int(gone.sum()),
        "spans": [{"start": int(a), "end": int(b)} for a, b in zip(spans[0::2], spans[1::2])],
        "kept": kept,
    }


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text with repeated chunks: counts, repeated byte ranges and the bytes kept."""
    rows = identified(docs, id_col, text_col)
    flags = materialise(shared_chunks(rows), "flags")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    counts = ["n_bytes", "n_chunks", "n_repeated_chunks", "n_repeated_bytes", "n_removed"]
    kinds = [pa.int64()] * 7 + [span, pa.binary()]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for ident, key, own, text in zip(*(c.to_pylist() for c in batch.columns)):
            found = judge(text, own)
            out.append((ident, key, *(found[c] for c in counts), found["spans"], found["kept"]))
        names = ["id", "key", *counts, "spans", "kept"]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=names)

    schema = (
        "id long, key long, " + ", ".join(f"{c} long" for c in counts)
        + ", spans array<struct<start:long,end:long>>, kept binary"
    )
    return map_arrow(with_texts(rows, flags), run, schema)


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: bytes, repeated and removed bytes, digest of the rest."""
    found = dedup(docs).select(
        "id", "key", "n_repeated_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("sha"),
    )
    found = materialise(found.dropDuplicates(["id", "key"]), "cut")
    rows = identified(docs, "doc_id", "text").select(
        "id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own")
    )
    none = F.lit(0).cast("long")
    return join_rows(rows, found, "left", small=fits_broadcast(found)).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.coalesce("n_repeated_bytes", none).alias("n_repeated_bytes"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("sha", "own").alias("kept_sha256"),
    )
