"""Ranked search against SQL (by the general test) and against plain Python."""

import math
import re

import numpy as np
import pytest

from citemill.llm import lexical_search as ls
from tests.llm.conftest import ODD, PROSE, frame, got

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=50):
    held = [(i, terms(t)) for i, t in docs]
    docs_n, words = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    out = []
    for item, text in items:
        rows = []
        for doc, w in held:
            score = 0
            for term in set(terms(text)):
                if tf := w.count(term):
                    df = sum(term in v for _, v in held)
                    m = 50 + (50 * len(w) * docs_n) // words
                    weight = math.floor(1000 * math.log((2 * docs_n + 2) / (2 * df + 1)))
                    score += weight * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, row[3], -row[0]) for r, row in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


def items(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "item_id long, text string, item string, rank int")


def found(df):
    return got(df.select("item_id", "rank", "doc_id", "score"))


ITEMS = [
    (1, PROSE),
    (2, "quick QUICK brown; fox2 word"),
    (3, None),
    (4, "... !!"),
    (5, "日本語 é"),
    (5, "日本語 é"),
    (None, "old bridges"),
    (6, "no such thing"),
]


def test_odd_rows(spark, odd):
    assert found(ls.search(odd, items(spark, ITEMS))) == brute(ODD, ITEMS)


def test_ties_at_the_cut(spark):
    docs = [(i, "alpha beta") for i in range(30, 0, -1)] + [(40, "alpha alpha gamma")] + [(None, "alpha beta")] * 3
    docs += [(41 + i, "delta words of others") for i in range(40)]
    asked = [(1, "alpha"), (2, "beta"), (3, "alpha beta gamma")]
    for k in (1, 7, 29, 50):
        rows = ls.search(frame(spark, docs).repartition(5), items(spark, asked), k=k)
        assert found(rows) == brute(docs, asked, k)


def test_empty_tables(spark, odd, nothing):
    assert found(ls.search(nothing, items(spark, ITEMS))) == []
    assert found(ls.search(odd, items(spark, []))) == []
    assert found(ls.search(frame(spark, [(1, None), (2, "")]), items(spark, ITEMS))) == []
    assert ls.search(odd, items(spark, [])).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items(spark, odd):
    assert found(ls.search(odd, items(spark, ITEMS), block_terms=8)) == brute(ODD, ITEMS)


def test_long_text(spark):
    docs = [(1, "alpha " * 400_000), (2, "alpha beta"), (3, "w" * 2_000_000), (4, "x y z " * 5)]
    asked = [(1, "alpha"), (2, "beta alpha")]
    assert found(ls.search(frame(spark, docs), items(spark, asked))) == brute(docs, asked)


@pytest.mark.parametrize("width", [1, 3, 1024])
def test_tiles_add_up(width):
    rng = np.random.default_rng(7)
    of_items = [np.unique(rng.integers(0, 50, 12)) for _ in range(70)]
    weight = rng.integers(0, 30_000, 50)
    row, term = (a.ravel() for a in np.mgrid[0:9, 0:50])
    impact = rng.integers(0, ls.MAX_IMPACT, len(row))
    scores = ls.products(9, row, term, impact, 70, ls.tiles(of_items, weight, width))
    table = impact.reshape(9, 50)
    expected = [[sum(int(table[d, t]) * int(weight[t]) for t in own) for own in of_items] for d in range(9)]
    assert scores.tolist() == expected


def test_partial_sums_stay_exact():
    # So heavy weights that only a few words may share a tile.
    weight = np.full(40, 2_000_000_000)
    parts = ls.tiles([np.arange(40)], weight)
    assert all(t.matrix.sum() * ls.MAX_IMPACT < 1 << 53 for t in parts) and len(parts) == 10
    assert ls.tiles([np.arange(40)], np.full(40, 28_000))[0].matrix.shape == (40, 1)


def test_long_collections_do_not_overflow():
    n = np.array([3, 1 << 22])
    out = ls.impacts(np.array([1, 5]), n, 1 << 38, 1 << 45)
    assert out.tolist() == [
        10**9 * t // (1000 * t + 20 * (50 + 50 * int(v) * (1 << 38) // (1 << 45))) for t, v in zip((1, 5), n)
    ]
