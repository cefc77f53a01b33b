"""Removal of repeated byte strings by suffix orders, built by linear grouping.

What is removed: every byte covered by a string of ``LENGTH`` bytes that starts
at another place too, in the same text or any other.

Strings are brought together by content. Of all ``CORE``-byte grams of a window
of ``LENGTH`` bytes the one with the smallest hash (the leftmost of equals) is
its anchor, so equal windows have equal anchors at equal offsets. The windows of
one anchor are a segment, a run of at most ``2 * LENGTH - CORE`` bytes. Segments
whose anchor occurs once hold nothing repeated, and segments that occur twice as
a whole are repeated throughout; both are known from hashes alone. Where an
anchor occurs in different segments, these segments (one of each) make a bucket,
and the bucket's suffixes are sorted: neighbours in the order that agree on
``LENGTH`` bytes are the repeated windows.

The suffix order of a bucket is built in two passes. The first takes groups of
suffixes in descending order; every member points to the nearest suffix before
it whose group is smaller, and those pointed to move to a new group right after
their own, the higher the more members point to them. At the end a group is the
set of suffixes with one longest Lyndon prefix. The second pass walks the order
from the smallest suffix on and puts each suffix, and those its pointers lead
to, at the next free place of its group. Nothing is renamed and no step is
repeated. Numpy does a step for many buckets at once.

A bucket of more than ``HOT`` different segments is not gathered. Its segments are
cut into cells of windows with neighbouring offsets, and a cell goes to a bucket
of the bytes that all windows of the cell share, first for cells of ``CELL``
windows and, where that is not enough, for single windows, which are equal
throughout a bucket. So a bucket holds at most ``HOT`` different strings.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes keep all their
bytes; copies of a text lose all bytes if long enough; equal rows are separate
texts with equal results; a null id stays null; an empty table gives an empty
result; other columns are not read. A text is worked on whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.llm.common import BYTE_CODES, as_bytes, join_rows, map_arrow, mix, powers, tidy
from citemill.shared import fits_broadcast, materialise

LENGTH = 200
CORE = 100
HOT = 256
CELL = 16
# Symbols sorted in one go, over all buckets of a batch.
BATCH_SYMBOLS = 1 << 18
_PLACE_BITS = np.uint64(26)


# --- anchors and segments ---------------------------------------------------------------


class Segments:
    """The segments of one text: anchor hash, segment hash, place of the anchor, first and last window."""

    def __init__(self, data: np.ndarray, length: int = LENGTH, core: int = CORE):
        n = len(data)
        if n < length:
            self.anchor = self.whole = np.empty(0, dtype=np.uint64)
            self.place = self.first = self.last = np.empty(0, dtype=np.int64)
            return
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[data] * up[:-1], out=sums[1:])
        grams = mix((sums[core:] - sums[:-core]) * down[: n - core + 1])
        width = length - core + 1
        self.place, self.first, self.last = leftmost_minima(grams, width)
        offset = (self.place - self.first).astype(np.uint64)
        self.anchor = grams[self.place]
        spans = (sums[self.last + length] - sums[self.first]) * down[self.first]
        # The reach of the segment is part of what it is.
        self.whole = mix(mix(spans) + offset + ((self.last - self.first).astype(np.uint64) << np.uint64(32)))


def leftmost_minima(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the smallest of each run of ``width`` values lies: places, first and last run of each.

    Very long inputs are worked on in overlapping parts, so that a place fits
    beside the hash in one number.
    """
    part = 1 << 24
    runs = len(values) - width + 1
    place = np.empty(runs, dtype=np.int64)
    low_bits = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    for start in range(0, runs, part):
        end = min(runs, start + part)
        part_values = values[start : end + width - 1]
        keyed = (part_values & ~low_bits) | np.arange(len(part_values), dtype=np.uint64)
        m = len(keyed)
        rows = np.concatenate([keyed, np.full(-m % width, ~np.uint64(0))]).reshape(-1, width)
        forward = np.minimum.accumulate(rows, axis=1).ravel()
        backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        lowest = np.minimum(backward[: m - width + 1], forward[width - 1 : m])
        place[start:end] = (lowest & low_bits).astype(np.int64) + start
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return place[first], first, np.append(first[1:], runs) - 1


# --- suffix order -----------------------------------------------------------------------


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts``."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def suffix_orders(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Suffix orders of several strings; string ``t`` is ``symbols[bounds[t]:bounds[t + 1]]``.

    Each string must end in a symbol smaller than all others in it. The order of
    a string fills the same range of the result.
    """
    n, begins = len(symbols), bounds[:-1]
    if n == 0:
        return np.empty(0, dtype=np.int64)
    string = np.repeat(np.arange(len(begins)), np.diff(bounds))
    order = np.lexsort((symbols, string))
    new = np.ones(n, dtype=bool)
    new[1:] = (symbols[order][1:] != symbols[order][:-1]) | (string[order][1:] != string[order][:-1])
    starts = np.flatnonzero(new)
    # A group is known by the first place of its range; place n stands for "none".
    group = np.full(n + 1, -1, dtype=np.int64)
    group[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    end = np.zeros(n + 1, dtype=np.int64)
    end[starts] = np.append(starts[1:], n)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    before = np.arange(-1, n, dtype=np.int64)  # the pointer of each suffix
    before[begins] = n
    moved = np.zeros(n, dtype=bool)
    upper = bounds[1:].copy()
    active = np.flatnonzero(upper > begins)
    while len(active):
        low = group[order[upper[active] - 1]]
        sizes = upper[active] - low
        upper[active] = low
        members = order[ragged(low, sizes)]
        own = np.repeat(low, sizes)
        active = active[low > begins[active]]
        # To the nearest suffix before with a smaller group.
        to = before[members]
        climb = np.flatnonzero(group[to] >= own)
        while len(climb):
            to[climb] = before[to[climb]]
            before[members[climb]] = to[climb]
            climb = climb[group[to[climb]] >= own[climb]]
        to = np.sort(to[to < n])
        if not len(to):
            continue
        firsts = np.flatnonzero(np.diff(to, prepend=-1))
        targets, times = to[firsts], np.diff(np.append(firsts, len(to)))
        old = group[targets]
        by = np.lexsort((times, old))
        targets, times, old = targets[by], times[by], old[by]
        heads = np.flatnonzero(np.diff(old, prepend=-1))
        counts = np.diff(np.append(heads, len(old)))
        last = end[old[heads]]
        slots = ragged(last - counts, counts)
        # The targets take the last places of their group, others make room.
        moved[targets] = True
        there = order[slots]
        others = there[~moved[there]]
        left = place[targets]
        free = left[left < np.repeat(last - counts, counts)]
        order[free], place[others] = others, free
        order[slots], place[targets] = targets, slots
        moved[targets] = False
        end[old[heads]] = last - counts
        edges = np.ones(len(old), dtype=bool)
        edges[1:] = (old[1:] != old[:-1]) | (times[1:] != times[:-1])
        runs = np.flatnonzero(edges)
        run_sizes = np.diff(np.append(runs, len(old)))
        group[targets] = np.repeat(slots[runs], run_sizes)
        end[slots[runs]] = slots[runs] + run_sizes
    return emitted(group, before, bounds)


def emitted(group: np.ndarray, before: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The order from the groups and pointers, smallest suffix first."""
    n, begins, ends = len(before) - 1, bounds[:-1], bounds[1:]
    before[n] = n
    result = np.empty(n, dtype=np.int64)
    free = np.arange(n + 1, dtype=np.int64)  # next free place, by group
    done = np.zeros(n + 1, dtype=bool)
    done[n] = True
    full = np.flatnonzero(ends > begins)
    result[begins[full]] = ends[full] - 1
    done[ends[full] - 1] = True
    at = begins[full].copy()
    limit = ends[full]
    first = begins[full]
    while len(at):
        suffix = result[at]
        s = np.where(suffix > first, suffix - 1, n)
        s = s[~done[s]]
        while len(s):
            g = group[s]
            result[free[g]] = s
            free[g] += 1
            done[s] = True
            s = before[s]
            s = s[~done[s]]
        at = at + 1
        on = at < limit
        if not on.all():
            at, limit, first = at[on], limit[on], first[on]
    return result


def repeated_windows(buckets: list[list[bytes]], length: int = LENGTH) -> list[list[np.ndarray]]:
    """For each text of each bucket the starts of windows that occur at least twice in the bucket."""
    symbols, bounds, pieces = [], [0], []
    for texts in buckets:
        total = 0
        for t in texts:
            pieces.append((bounds[-1] + total, len(t)))
            symbols.append(np.frombuffer(t, dtype=np.uint8).astype(np.int16) + 2)
            symbols.append(np.ones(1, dtype=np.int16))
            total += len(t) + 1
        symbols.append(np.zeros(1, dtype=np.int16))
        bounds.append(bounds[-1] + total + 1)
    data, edges = np.concatenate(symbols), np.array(bounds, dtype=np.int64)
    order = suffix_orders(data, edges)
    starts, sizes = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    windows = np.maximum(sizes - length + 1, 0)
    eligible = np.zeros(len(data), dtype=bool)
    eligible[ragged(starts, windows)] = True
    # Suffixes that agree on a whole window are neighbours among those that have one.
    ranked = order[eligible[order]]
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[data & 0xFF] * up[:-1], out=sums[1:])
    value = mix((sums[ranked + length] - sums[ranked]) * down[ranked])
    bucket = np.searchsorted(edges, ranked, side="right")
    same = np.zeros(len(ranked) + 1, dtype=bool)
    same[1:-1] = (value[1:] == value[:-1]) & (bucket[1:] == bucket[:-1])
    hit = np.zeros(len(data), dtype=bool)
    hit[ranked[same[1:] | same[:-1]]] = True
    found = iter([np.flatnonzero(hit[a : a + max(0, w)]) for a, w in zip(starts, windows)])
    return [[next(found) for _ in texts] for texts in buckets]


# --- the jobs ---------------------------------------------------------------------------


def ranges(numbers: np.ndarray) -> list[dict]:
    """Runs of consecutive numbers as first and last."""
    if not len(numbers):
        return []
    cuts = np.flatnonzero(np.diff(numbers) > 1)
    first = numbers[np.append(0, cuts + 1)]
    last = numbers[np.append(cuts, len(numbers) - 1)]
    return [{"low": int(a), "high": int(b)} for a, b in zip(first, last)]


RANGES = "array<struct<low:int,high:int>>"
RANGES_ARROW = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def marks(rows: DataFrame) -> DataFrame:
    """Per text: distinct (anchor, segment) hashes and how often each occurs in it."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        anchors, wholes, times = [], [], []
        for text in batch.column(2).to_pylist():
            s = Segments(np.frombuffer(text, dtype=np.uint8))
            by = np.lexsort((s.whole, s.anchor))
            a, w = s.anchor[by], s.whole[by]
            new = np.ones(len(a), dtype=bool)
            new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1])
            at = np.flatnonzero(new)
            anchors.append(a[at].view(np.int64))
            wholes.append(w[at].view(np.int64))
            times.append(np.diff(np.append(at, len(a))).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(anchors, type=pa.list_(pa.int64())),
                pa.array(wholes, type=pa.list_(pa.int64())),
                pa.array(times, type=pa.list_(pa.int32())),
            ],
            names=["id", "key", "anchors", "wholes", "times"],
        )

    texts = rows.filter(F.octet_length("text") >= LENGTH).select("id", "key", as_bytes("text").alias("text"))
    return map_arrow(texts, run, "id long, key long, anchors array<long>, wholes array<long>, times array<int>")


def join_small(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Inner join whose small side is broadcast if it measures small.

    Otherwise both sides are shuffled; a hot key is a skewed partition of the
    join, which adaptive execution splits.
    """
    return big.join(F.broadcast(small) if fits_broadcast(small) else small, on)


def with_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` joined to the per-text columns of ``wanted`` (unique id, key)."""
    keys = materialise(wanted.select("id", "key"), "texts")
    chosen = join_rows(rows, keys, "left_semi", small=fits_broadcast(keys))
    others = [c for c in wanted.columns if c not in ("id", "key")]
    return join_rows(chosen, wanted).select("id", "key", *others, as_bytes("text").alias("text"))


def bucket_rows(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """Bytes of one occurrence of each wanted segment: ``anchor, whole, times, segments, offset, bytes``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for wanted, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            s = Segments(np.frombuffer(text, dtype=np.uint8))
            known = {}
            for i, pair in enumerate(zip(s.anchor.view(np.int64).tolist(), s.whole.view(np.int64).tolist())):
                known.setdefault(pair, i)
            for w in wanted:
                i = known[w["anchor"], w["whole"]]
                a, b = int(s.first[i]), int(s.last[i]) + LENGTH
                out.append((w["anchor"], w["whole"], w["times"], w["segments"], int(s.place[i]) - a, text[a:b]))
        if out:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            names = ["anchor", "whole", "times", "segments", "offset", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=names)

    wanted = firsts.groupBy("id", "key").agg(
        F.collect_list(F.struct("anchor", "whole", "times", "segments")).alias("wanted")
    )
    schema = "anchor long, whole long, times long, segments long, offset int, bytes binary"
    return map_arrow(with_texts(rows, materialise(wanted, "wanted")), run, schema)


def sorted_buckets(segments: DataFrame) -> DataFrame:
    """``anchor, whole, found``: ranges of repeated windows of each segment, from suffix orders."""
    ordered = segments.repartition("anchor").sortWithinPartitions("anchor", "whole")
    ordered = ordered.select("anchor", "whole", "times", "bytes")

    def solve(buckets: list[list[tuple]]) -> pa.RecordBatch:
        several = [b for b in buckets if len(b) > 1]
        starts = iter(repeated_windows([[r[3] for r in b] for b in several]) if several else [])
        out = []
        for bucket in buckets:
            for row, own in zip(bucket, next(starts) if len(bucket) > 1 else [()]):
                # A segment that occurs several times is repeated as a whole.
                own = np.arange(len(row[3]) - LENGTH + 1) if row[2] > 1 else own
                if len(own):
                    out.append((row[0], row[1], ranges(own)))
        columns = list(zip(*out)) or [(), (), ()]
        kinds = [pa.int64(), pa.int64(), RANGES_ARROW]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=k) for c, k in zip(columns, kinds)], names=["anchor", "whole", "found"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        waiting, size = [], 0
        for _, bucket in groupby(rows, key=lambda r: r[0]):
            waiting.append(list(bucket))
            size += sum(len(r[3]) + 1 for r in waiting[-1]) + 1
            if size >= BATCH_SYMBOLS:
                yield solve(waiting)
                waiting, size = [], 0
        if waiting:
            yield solve(waiting)

    return ordered.mapInArrow(tidy(run), f"anchor long, whole long, found {RANGES}")


def hashed(*values) -> int:
    h = blake2b(digest_size=8)
    for v in values:
        h.update(v if isinstance(v, bytes) else b"%d;" % v)
    return int.from_bytes(h.digest(), "little", signed=True)


def cells(segments: DataFrame, width: int) -> DataFrame:
    """Segments cut into cells of ``width`` window offsets, each with the anchor its cell has.

    ``own_anchor, own_whole, shift`` say which segment a cell comes from and which
    window of it is the cell's first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own_anchor, own_whole, shift, anchor, times, offset, data in zip(*(c.to_pylist() for c in batch.columns)):
                # A window that begins ``back`` bytes before the anchor lies in cell ``back // width``.
                first, last = 0, len(data) - LENGTH
                while first <= last:
                    cell = (offset - first) // width
                    end = min(last, offset - cell * width)
                    core = data[offset - cell * width : offset - cell * width - width + 1 + LENGTH]
                    piece = data[first : end + LENGTH]
                    out.append((
                        own_anchor, own_whole, shift + first, hashed(anchor, cell, core),
                        hashed(offset - first, piece), times, offset - first, piece,
                    ))
                    first = end + 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            columns = list(zip(*out)) or [()] * len(kinds)
            names = ["own_anchor", "own_whole", "shift", "anchor", "whole", "times", "offset", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

    rows = segments.select("own_anchor", "own_whole", "shift", "anchor", "times", "offset", "bytes")
    return rows.mapInArrow(
        tidy(run),
        "own_anchor long, own_whole long, shift int, anchor long, whole long, times long, offset int, bytes binary",
    )


def hot_buckets(segments: DataFrame) -> DataFrame | None:
    """The same as :func:`sorted_buckets` for buckets with very many segments, if there are any."""
    rows = segments.select(
        F.col("anchor").alias("own_anchor"), F.col("whole").alias("own_whole"), F.lit(0).alias("shift"),
        "anchor", "times", "offset", "bytes",
    )
    parts = []
    for width in (CELL, 1):
        if rows.isEmpty():
            break
        cut = materialise(cells(rows, width), "cells")
        different = cut.groupBy("anchor", "whole").agg(
            F.sum("times").alias("times"), F.first("bytes").alias("bytes")  # equal bytes
        )
        different = materialise(different, "cell-segments")
        many = different.groupBy("anchor").agg(F.count("*").alias("segments")).filter(F.col("segments") > HOT)
        many = materialise(many.select("anchor"), "hot-cells")
        few = different.join(many, "anchor", "left_anti")
        found = materialise(sorted_buckets(few), "found-cells").withColumnRenamed("found", "cell_found")
        parts.append(
            cut.join(found, ["anchor", "whole"]).select(
                F.col("own_anchor").alias("anchor"),
                F.col("own_whole").alias("whole"),
                F.transform(
                    "cell_found",
                    lambda r: F.struct((r["low"] + F.col("shift")).alias("low"), (r["high"] + F.col("shift")).alias("high")),
                ).alias("found"),
            )
        )
        rows = cut.join(many, "anchor", "left_semi")
    if not parts:
        return None
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return found.groupBy("anchor", "whole").agg(F.flatten(F.collect_list("found")).alias("found"))


def repeats(rows: DataFrame) -> DataFrame:
    """``id, key, flags`` of texts with repeats: (anchor, whole, ranges; no ranges: all windows)."""
    marked = materialise(marks(rows), "marks")
    zipped = F.explode(F.arrays_zip("anchors", "wholes", "times")).alias("m")
    each = marked.select("id", "key", zipped).select(
        "id", "key", F.col("m.anchors").alias("anchor"), F.col("m.wholes").alias("whole"), F.col("m.times").alias("times")
    )
    common = (
        each.groupBy("anchor")
        .agg(F.sum("times").alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high"))
        .filter("n > 1")
        .select("anchor", (F.col("low") == F.col("high")).alias("one"))
    )
    common = materialise(common, "common")
    # Most anchors of a text meet here: shuffled at any size, since what is repeated grows with the input.
    met = materialise(each.join(common.hint("merge"), "anchor"), "met")

    different = met.filter(~F.col("one")).groupBy("anchor", "whole").agg(
        F.sum("times").alias("times"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("at")
    )
    different = materialise(different.select("anchor", "whole", "times", "at.id", "at.key"), "segments")
    counts = different.groupBy("anchor").agg(F.count("*").alias("segments"))
    firsts = different.join(counts, "anchor")
    segments = materialise(bucket_rows(rows, firsts), "buckets")
    found = sorted_buckets(segments.filter(F.col("segments") <= HOT))
    hot = hot_buckets(segments.filter(F.col("segments") > HOT))
    found = materialise(found if hot is None else found.unionByName(hot), "found")

    wholly = met.filter("one").select("id", "key", "anchor", "whole", F.lit(None).cast(RANGES).alias("found"))
    partly = join_small(met.filter(~F.col("one")), found, ["anchor", "whole"])
    flags = wholly.unionByName(partly.select("id", "key", "anchor", "whole", "found"))
    return flags.groupBy("id", "key").agg(F.collect_list(F.struct("anchor", "whole", "found")).alias("flags"))


def repeated_bytes(text: bytes, flags: list[dict]) -> np.ndarray:
    """Which bytes of a text lie in a repeated window."""
    data = np.frombuffer(text, dtype=np.uint8)
    s = Segments(data)
    known = {(f["anchor"], f["whole"]): f["found"] for f in flags}
    change = np.zeros(len(data) + 1, dtype=np.int32)
    for i, pair in enumerate(zip(s.anchor.view(np.int64).tolist(), s.whole.view(np.int64).tolist())):
        if pair not in known:
            continue
        for r in known[pair] or [{"low": 0, "high": int(s.last[i] - s.first[i])}]:
            change[s.first[i] + r["low"]] += 1
            change[s.first[i] + r["high"] + LENGTH] -= 1
    return np.cumsum(change[:-1]) > 0


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, key, n_bytes, n_removed, n_spans, spans, kept`` of the texts that lose bytes.

    ``spans`` are byte ranges (end exclusive), ``kept`` the remaining bytes.
    """
    rows = identified(docs, id_col, text_col)
    flags = materialise(repeats(rows), "flags")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for ident, key, own, text in zip(*(c.to_pylist() for c in batch.columns)):
            gone = repeated_bytes(text, own)
            edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(edges[0::2], edges[1::2])]
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            out.append((ident, key, len(text), int(gone.sum()), len(spans), spans, kept))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), span, pa.binary()]
        names = ["id", "key", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=names)

    schema = (
        "id long, key long, n_bytes long, n_removed long, n_spans long,"
        " spans array<struct<start:long,end:long>>, kept binary"
    )
    return map_arrow(with_texts(rows, flags), run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per row of ``docs``."""
    cut = dedup(docs).select("id", "key", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    cut = materialise(cut.dropDuplicates(["id", "key"]), "cut")
    rows = identified(docs, "doc_id", "text").select(
        "id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own")
    )
    none = F.lit(0).cast("long")
    return join_rows(rows, cut, "left", small=fits_broadcast(cut)).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("sha", "own").alias("kept_sha256"),
    )
