from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm.conftest import ODD, frame, got, texts_of

from citemill.llm import ngram_rtree as j
from citemill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(texts, n=3, percent=90):
    sets = [shingles(t, n) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    root[find(a)] = find(b)
    members = defaultdict(list)
    for i in range(len(texts)):
        members[find(i)].append(texts[i][0])
    smallest = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    out = [(t[0], len(s), smallest[find(i)] if s else t[0]) for i, (t, s) in enumerate(zip(texts, sets))]
    return sorted(out, key=str)


def families(seed, n_families, size, words, edits):
    """Documents that differ from their family's first one in some words."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n_families):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(*words))]
        for _ in range(size):
            own = list(base)
            for _ in range(draw.randint(0, edits)):
                at = draw.randrange(len(own))
                own[at : at + 1] = draw.choice([[], ["x%d" % draw.randrange(99)], [own[at], own[at]]])
                own = own or ["y"]
            texts.append(" ".join(own))
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("case", [(1, 12, 8, (5, 40), 3), (2, 3, 40, (60, 300), 14), (3, 2, 30, (300, 900), 40)])
def test_components_match_brute_force(spark, case):
    texts = families(*case)
    assert got(j.digest(frame(spark, texts))) == brute(texts)


def test_blocks_and_rounds_lose_nothing(spark, monkeypatch):
    # Python workers get the functions by value only for what the driver's plan holds, so blocks are cut here.
    monkeypatch.setattr(j, "BLOCK", 16)
    texts = families(4, 2, 60, (80, 120), 9)
    assert got(j.digest(frame(spark, texts))) == brute(texts)


def test_real_documents(sample):
    assert got(j.digest(sample)) == brute(texts_of(sample))


def test_odd_rows(odd):
    assert got(j.digest(odd)) == brute(ODD)


def test_empty_table(nothing):
    assert j.digest(nothing).count() == 0
    assert got(j.keep_one(nothing)) == []


def test_keep_one_leaves_one_of_each_component(spark, odd):
    kept = j.keep_one(odd)
    assert kept.columns == odd.columns
    rows = got(kept, "doc_id", "text")
    found = brute(ODD)
    groups = {c for i, n, c in found if n}
    empty = [i for i, n, c in found if not n]
    assert len(rows) == len(groups) + len(empty)
    texts = families(5, 6, 10, (30, 60), 3)
    docs = frame(spark, texts)
    assert [r[0] for r in got(j.keep_one(docs), "doc_id")] == sorted({c for _, _, c in brute(texts)}, key=lambda i: str((i,)))


def test_pairs_within_the_threshold_share_a_bucket():
    draw = np.random.default_rng(7)
    for _ in range(2000):
        n = int(draw.integers(9, 400))
        a = np.unique(draw.integers(0, 1 << 63, n).astype(np.uint64))
        n = len(a)
        d = j.most_different(2 * n)
        drop = int(draw.integers(0, d + 1))
        b = np.delete(a, draw.choice(n, drop, replace=False)) if drop else a
        b = np.union1d(b, draw.integers(0, 1 << 63, int(draw.integers(0, d + 1))).astype(np.uint64))
        if j.linked(a, b) and len(a) + len(b) - 2 * len(np.intersect1d(a, b)):
            assert len(np.intersect1d(j.bucket_keys(a), j.bucket_keys(b)))


def test_tree_gives_all_pairs_the_bound_allows():
    draw = np.random.default_rng(8)
    base = draw.integers(0, 1 << 63, (5, 200)).astype(np.uint64)
    sets = [np.unique(np.append(base[i % 5][: 150 + i % 50], draw.integers(0, 1 << 63, i % 9).astype(np.uint64))) for i in range(400)]
    p = j.Points([j.group_counts(s) for s in sets], [len(s) for s in sets])
    everything = j.Tree(p, np.arange(400))
    pairs = {tuple(sorted(x)) for a, b in j.tree_pairs(p, everything, everything, True) for x in zip(a.tolist(), b.tolist())}
    left, right = j.Tree(p, np.arange(30)), j.Tree(p, np.arange(30, 400))
    across = {tuple(sorted(x)) for a, b in j.tree_pairs(p, left, right, False) for x in zip(a.tolist(), b.tolist())}
    for a in range(400):
        for b in range(a):
            ok = j.overlap_bound(p.counts[a], p.counts[b], p.excess[a], p.excess[b]) >= j.needed(p.sizes[a] + p.sizes[b])
            assert ((b, a) in pairs) == ok
            if b < 30 <= a:
                assert ((b, a) in across) == ok
            if j.linked(sets[a], sets[b]):
                assert ok


def test_large_counts_keep_the_bound():
    a = np.arange(0, 128 * 1000, 128).astype(np.uint64)  # one group holds all
    p = j.Points([j.group_counts(a), j.group_counts(a[:950])], [1000, 950])
    assert j.overlap_bound(p.counts[0], p.counts[1], p.excess[0], p.excess[1]) >= 950


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 150)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}}


def pairs_of(texts, n, percent):
    """Linked pairs by brute force for any shingle length and percentage."""
    words = [WORD.findall((t or "").lower()) for _, t in texts]
    sets = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set() for w in words]
    return [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]


@pytest.mark.parametrize("n, percent", [(5, 80), (4, 50), (2, 100)])
def test_keep_one_takes_length_and_similarity(spark, n, percent):
    texts = families(6, 8, 10, (6, 60), 3) + families(7, 4, 20, (150, 400), 14)
    texts = [(i, t) for i, (_, t) in enumerate(texts)]
    first = list(range(len(texts)))
    for a, b in pairs_of(texts, n, percent):
        first = [min(first[a], first[b]) if f in (first[a], first[b]) else f for f in first]
    kept = j.keep_one(frame(spark, texts), n=n, percent=percent)
    assert got(kept, "doc_id") == sorted(((i,) for i in set(first)), key=str)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_partners_share_a_bucket_at_any_percentage(percent):
    draw = np.random.default_rng(9)
    checked = 0
    for _ in range(2000):
        a = np.unique(draw.integers(0, 1 << 63, int(draw.integers(1, 400))).astype(np.uint64))
        d = j.most_different(len(a) + j.largest_partner(len(a), percent), percent)
        drop = int(draw.integers(0, min(d, len(a) - 1) + 1))
        b = np.delete(a, draw.choice(len(a), drop, replace=False)) if drop else a
        b = np.union1d(b, draw.integers(0, 1 << 63, int(draw.integers(0, d - drop + 1))).astype(np.uint64))
        if j.linked(a, b, percent) and len(a) + len(b) - 2 * len(np.intersect1d(a, b)):
            checked += 1
            assert len(np.intersect1d(j.bucket_keys(a, percent), j.bucket_keys(b, percent)))
    assert checked > 300


def test_second_round_asks_one_partner_for_each_open_set():
    draw = np.random.default_rng(11)
    base = draw.integers(0, 1 << 63, 300).astype(np.uint64)
    sets = [np.union1d(base[10:], draw.integers(0, 1 << 63, 3).astype(np.uint64)) for _ in range(80)]
    sets.append(draw.integers(0, 1 << 63, 300).astype(np.uint64))
    cls = [bytes([i]) for i in range(len(sets))]
    # 60 sets are in the largest component (blocks below zero), the others alone.
    rows = [
        (-1 if i < 60 else 0, cls[i], len(s), j.group_counts(np.unique(s)), b"top" if i < 60 else cls[i], -1, 0)
        for i, s in enumerate(sets)
    ]
    likeliest, everything = (list(j.bucket_pairs(rows, number)) for number in (2, 3))
    assert len(likeliest) == 20 and len(everything) == 20 * 60
    assert {x for pair in likeliest for x in pair} >= set(cls[60:80])
    assert all(j.linked(sets[cls.index(a)], sets[cls.index(b)]) for a, b in likeliest)


def variants(seed, number, words, edits):
    """Near copies of one text, each with so many words of its own."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(words)]
    texts = []
    for k in range(number):
        own = list(base)
        for at in draw.sample(range(words), edits):
            own[at] = f"x{k}_{at}"
        texts.append((k, " ".join(own)))
    return texts


def test_third_round_gives_a_pair_in_few_of_its_buckets(spark, monkeypatch):
    texts = variants(12, 24, 2000, 20)
    docs = frame(spark, texts)
    made, kind = [], type(docs)
    plain = kind.mapInArrow

    def noted(df, f, schema, *more, **named):
        out = plain(df, f, schema, *more, **named)
        if schema == "a binary, b binary":
            made.append(out)
        return out

    monkeypatch.setattr(kind, "mapInArrow", noted)
    monkeypatch.setattr(j, "GIVEN", 0)  # a task alone remembers nothing, as if buckets lay in many tasks
    assert got(j.digest(docs)) == brute(texts)
    rounds = made[0::2]  # candidates and verified pairs take turns
    assert len(rounds) == 3
    pairs = rounds[2].distinct().count()
    assert pairs > 100 and rounds[2].count() <= 2 * pairs


def test_bucket_keys_are_stored_once(spark, monkeypatch):
    stored, plain = [], j.materialise

    def noted(df, name):
        stored.append((name, df.columns))
        return plain(df, name)

    monkeypatch.setattr(j, "materialise", noted)
    texts = families(13, 4, 10, (30, 60), 3)
    docs = frame(spark, texts + texts[:5])  # equal rows are one class
    found = j.membership(docs)
    assert found.count() == len(texts) + 5
    assert [name for name, columns in stored if "keys" in columns] == ["points"]
    # Only with the row: a bucket's rows do not carry the counts of their sets.
    filed = next(columns for name, columns in stored if name == "filed")
    assert filed == ["cls", "n", "counts", "buckets"]
