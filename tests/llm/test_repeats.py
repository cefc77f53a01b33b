"""Suffix groups and gear chunks."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.conftest import ODD, frame, got, texts_of

from citemill.llm import gear_chunks as g
from citemill.llm import suffix_groups as s


def brute(texts, length=s.LENGTH):
    data = [(t or "").encode() for _, t in texts]
    windows = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (ident, _), d in zip(texts, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if windows[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, x in zip(d, gone) if not x)
        out.append((ident, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def pasted(seed, n, alphabet="abcdefgh ij"):
    """Texts that share stretches of about the length that counts."""
    draw = random.Random(seed)
    text = lambda k: "".join(draw.choice(alphabet) for _ in range(k))
    pool = [text(draw.randint(150, 500)) for _ in range(12)]
    texts = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(1, 4)):
            p = draw.choice(pool)
            a = draw.randrange(0, 60)
            parts += [text(draw.randint(0, 120)), p[a : a + draw.randint(150, 400)]]
        texts.append((i, "".join(parts) + text(draw.randint(0, 50))))
    return texts


@pytest.mark.parametrize("case", [(1, 60, "abcdefgh ij"), (2, 40, "ab"), (3, 30, "é日a ")])
def test_removed_bytes_match_brute_force(spark, case):
    texts = pasted(*case)
    assert got(s.digest(frame(spark, texts))) == brute(texts)


@pytest.mark.parametrize(("hot", "cell"), [(2, 16), (1, 40), (2, 1)])
def test_hot_buckets_match_brute_force(spark, monkeypatch, hot, cell):
    monkeypatch.setattr(s, "HOT", hot)
    monkeypatch.setattr(s, "CELL", cell)
    texts = pasted(4, 40)
    assert got(s.digest(frame(spark, texts))) == brute(texts)


def test_real_documents(sample):
    assert got(s.digest(sample)) == brute(texts_of(sample))


def test_odd_rows(odd):
    assert got(s.digest(odd)) == brute(ODD)


def test_runs_and_periods(spark):
    texts = [(1, "a" * 199), (2, "a" * 200), (3, "b" * 201), (4, "ab" * 500), (5, "c" * 200 + "d" * 200), (6, "c" * 200)]
    assert got(s.digest(frame(spark, texts))) == brute(texts)


def test_empty_table(nothing):
    assert s.digest(nothing).count() == 0
    assert g.report(nothing).count() == 0


def test_suffix_orders():
    draw = random.Random(1)
    strings = []
    for trial in range(400):
        letters = draw.choice([1, 2, 3, 26])
        strings.append([draw.randint(1, letters) for _ in range(draw.randint(0, 70))] + [0])
    strings += [[1, 2] * 40 + [0], [2, 1] * 40 + [0], [1] * 60 + [0], [3, 2, 1] * 20 + [0]]
    bounds = np.cumsum([0] + [len(x) for x in strings])
    order = s.suffix_orders(np.array(sum(strings, []), dtype=np.int16), bounds)
    for x, a, b in zip(strings, bounds, bounds[1:]):
        assert (order[a:b] - a).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def test_anchor_of_a_window_depends_on_the_window_alone():
    draw = np.random.default_rng(2)
    for alphabet in (2, 20):
        shared = draw.integers(97, 97 + alphabet, 300).astype(np.uint8)
        offsets = defaultdict(set)
        for _ in range(20):
            left, right = (draw.integers(97, 97 + alphabet, int(draw.integers(0, 90))).astype(np.uint8) for _ in "ab")
            own = s.Segments(np.concatenate([left, shared, right]))
            for a, p, i, k in zip(own.anchor, own.place, own.first, own.last):
                for window in range(int(i), int(k) + 1):
                    if 0 <= window - len(left) <= 100:
                        offsets[window - len(left)].add((int(a), int(p) - window))
        assert len(offsets) == 101 and all(len(v) == 1 for v in offsets.values())


# --- chunks ---------------------------------------------------------------------------


def chunk_brute(texts):
    """Chunk by chunk in plain Python, from the rolling definition of the hash."""
    gear = g.GEAR.tolist()
    cut = []
    for ident, text in texts:
        data, h, start, own = (text or "").encode(), 0, 0, []
        for i, b in enumerate(data, 1):
            h = ((h << 1) + gear[b]) & 0xFFFFFFFF
            if (h >> (32 - g.CUT_BITS) == 0 and i - start >= g.SMALLEST) or i - start == g.LARGEST or i == len(data):
                own.append((start, i))
                start = i
        cut.append((ident, data, own))
    order = sorted(range(len(cut)), key=lambda i: (cut[i][0] is None, cut[i][0] or 0))
    times = Counter(d[a:b] for _, d, own in cut for a, b in own)
    return cut, order, times


def test_chunks_follow_the_rolling_hash(sample):
    for _, data, own in chunk_brute(texts_of(sample)[:60])[0]:
        starts, ends, _ = g.chunks(data)
        assert list(zip(starts.tolist(), ends.tolist())) == own


def test_repeated_runs_match_brute_force(spark, sample):
    for texts in (texts_of(sample), pasted(6, 50, "abcdefghijklmnopqrstuvwxyz ")):
        cut, _, times = chunk_brute(texts)
        expected = []
        for ident, data, own in cut:
            hit, run = 0, []
            for a, b in [*own, (None, None)]:
                if a is not None and times[data[a:b]] > 1:
                    run.append((a, b))
                    continue
                if run and run[-1][1] - run[0][0] >= g.RUN_BYTES:
                    hit += run[-1][1] - run[0][0]
                run = []
            expected.append((ident, len(data), hit))
        assert got(g.report(frame(spark, texts)), "doc_id", "n_bytes", "n_repeated_bytes") == sorted(expected, key=str)


def test_one_copy_stays_and_insertions_are_survived(spark):
    draw = random.Random(9)
    words = [f"{draw.randrange(10**6):x}" for _ in range(3000)]
    base = " ".join(words)
    texts = [(5, base), (2, base), (3, base[:7000] + " inserted " + base[7000:]), (9, "short"), (4, "short")]
    rows = {r["doc_id"]: r for r in g.report(frame(spark, texts)).collect()}
    assert rows[2]["n_removed"] == 0 and rows[2]["n_repeated_bytes"] == len(base)
    assert rows[5]["n_removed"] == len(base)
    assert rows[5]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert rows[3]["n_removed"] > 0.95 * len(base)
    assert rows[9]["n_removed"] == rows[4]["n_removed"] == 0


def test_chunks_of_odd_rows(odd):
    rows = g.report(odd).collect()
    assert len(rows) == len(ODD)
    assert sorted(r["n_bytes"] for r in rows) == sorted(len((t or "").encode()) for _, t in ODD)


def test_suffix_orders_are_built_in_little_memory():
    """A batch of buckets as large as a task gathers."""
    draw = np.random.default_rng(5)
    bucket = [draw.integers(97, 123, 300, dtype=np.uint8).tobytes() for _ in range(50)]
    buckets = [bucket] * (1 + s.BATCH_SYMBOLS // (50 * 301))
    tracemalloc.start()
    found = s.repeated_windows(buckets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == len(buckets) and peak < 80e6


def test_anchors_meet_by_shuffle_at_any_size(spark, monkeypatch):
    plans, plain = {}, s.materialise

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name)

    monkeypatch.setattr(s, "materialise", noted)
    texts = pasted(14, 20)
    assert got(s.digest(frame(spark, texts))) == brute(texts)
    assert "SortMergeJoin" in plans["met"] and "BroadcastHashJoin" not in plans["met"]
