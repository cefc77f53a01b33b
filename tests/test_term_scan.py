"""The trie and the Bloom filter against plain scanning."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from citemill import corpus
from citemill.functions.text import REMOVED_PUNCTUATION, WORD_SPACES
from citemill.operators import tagger, term_scan
from citemill.shared import ARROW_ROWS

SF = "/root/testdata/sf0.001"
WORD = re.compile(f"[^{WORD_SPACES}]+")
GONE = str.maketrans("", "", REMOVED_PUNCTUATION)


def brute(text: str, terms: list[tuple[str, str]]) -> list[tuple]:
    """All occurrences of all terms, n-gram by n-gram."""
    found = [(m.start(), m.end(), m.group().lower().translate(GONE)) for m in WORD.finditer(text)]
    out = []
    for term, label in terms:
        n = term.count(" ") + 1
        for i in range(len(found) - n + 1):
            if " ".join(w for *_, w in found[i : i + n]) == term:
                raw = text[found[i][0] : found[i + n - 1][1]]
                surface = raw.strip(REMOVED_PUNCTUATION)
                start = found[i][0] + len(raw) - len(raw.lstrip(REMOVED_PUNCTUATION))
                out.append((start, start + len(surface), label, surface, term))
    return sorted(out)


TERMS = [("a", "X"), ("a", "Y"), ("a b", "X"), ("a b c", "Z"), ("", "E"), ("b  c", "X"), ("i\u0307", "I"), ("b", "X"), ("é", "Q")]
WORDS = ["a", "A.", "(b", "b,", "c", "...", "İ", "é", "É!", "xyz", "\U0001f600", "a" * 300]


def texts(seed: int) -> list[str]:
    draw = random.Random(seed)
    spaces = [" ", "  ", "\n", "\t", "\x85", "\xa0", "\x1c"]
    made = ["".join(draw.choice(WORDS) + draw.choice(spaces) for _ in range(draw.randint(0, 40))) for _ in range(60)]
    return ["", " ", "...", "\xa0a", "a", *made]


@pytest.mark.parametrize("hashed", [1 << 18, 64])
def test_trie_finds_what_scanning_finds(monkeypatch, hashed):
    monkeypatch.setattr(term_scan, "HASHED", hashed)
    trie = term_scan.Trie(*map(list, zip(*TERMS)))
    given = texts(1)
    found = term_scan.trie_spans(trie, given, False)
    for text, own in zip(given, found):
        assert sorted((s["start"], s["end"], s["label"], s["surface"], s["term"]) for s in own) == brute(text, TERMS)


def test_no_term_crosses_two_texts():
    trie = term_scan.Trie(["a b"], ["X"])
    assert term_scan.trie_spans(trie, ["a", "b", "a b", "b a"], False)[0:2] == [[], []]


def test_overlaps_are_settled_from_the_left():
    trie = term_scan.Trie(["a", "a b", "b c d", "c", "d"], list("VWXYZ"))
    assert [(s["start"], s["end"], s["label"]) for s in term_scan.trie_spans(trie, ["a b c d"], True)[0]] == [
        (0, 3, "W"), (4, 5, "Y"), (6, 7, "Z")
    ]


def test_long_texts_and_words_are_hashed_in_pieces():
    word = "w" * 700_000
    trie = term_scan.Trie([word, f"{word} a"], ["L", "M"])
    text = f"{word} A. {word}x {word[:-1]} {word.upper()}"
    assert sorted(s["label"] for s in term_scan.trie_spans(trie, [text], False)[0]) == ["L", "L", "M"]
    many = "a b c " * 300_000
    assert len(term_scan.trie_spans(term_scan.Trie(["b c a"], ["X"]), [many], False)[0]) == 299_999


def test_bloom_passes_every_term_and_little_else(spark):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    terms = list({" ".join(draw.choices(vocabulary, k=draw.choice([1, 2, 3]))) for _ in range(2000)})
    table = spark.createDataFrame([(t, t.count(" ") + 1, "X") for t in terms], "term string, n int, label string")
    bloom = term_scan.bloom_of(table)
    text = " ".join(draw.choices(vocabulary, k=20_000)) + " " + " ".join(terms)
    probable = [s["term"] for s in term_scan.bloom_spans(bloom, [text])[0]]
    real = [s["term"] for s in term_scan.trie_spans(term_scan.Trie(terms, ["X"] * len(terms)), [text], False)[0]]
    known = set(terms)
    assert sorted(t for t in probable if t in known) == sorted(real)
    assert len(probable) <= 1.05 * len(real) + 50


def test_only_probable_hits_are_shuffled(spark, monkeypatch):
    """With broadcasts off, what reaches the join is close to the matches."""
    docs = corpus.articles(spark, SF).select("doc_id", "abstract", "title")
    dictionary = corpus.dictionary(spark, SF)
    args = (docs, dictionary, ["doc_id"], ["abstract", "title"])
    expected = rows(tagger.matches(*args))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = corpus.dictionary(spark, SF)
        assert not large.is_small()
        assert rows(tagger.matches(docs, large, ["doc_id"], ["abstract", "title"])) == expected
        hits = tagger.probable_hits(docs, large, ["doc_id"], ["abstract", "title"]).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len({r[:4] for r in expected}) <= hits <= 1.1 * len(expected) + 20


def test_scan_leaves_no_candidate_rows(spark, plan):
    docs = corpus.articles(spark, SF).select("doc_id", "abstract")
    found = tagger.tag(docs, corpus.dictionary(spark, SF), ["doc_id"], ["abstract"])
    text = plan(found)
    assert "ArrowEvalPython" in text and "Exchange" not in text and "Join" not in text


def test_hashes_do_not_depend_on_the_neighbours():
    one, two = (term_scan.Words([t]) for t in ("alpha beta", "x yy alpha zzz beta"))
    assert np.array_equal(one.hashes[0], two.hashes[0][[2, 4]]) and np.array_equal(one.hashes[1], two.hashes[1][[2, 4]])


def test_a_scan_takes_small_batches_and_texts_one_by_one(spark):
    texts = pa.array(["ab cd", None, "x" * (2 * term_scan.PIECE), "", "cd"])
    assert list(term_scan.pieces(texts)) == [["ab cd", ""], ["x" * (2 * term_scan.PIECE)], ["", "cd"]]
    dictionary = tagger.Dictionary.of(spark.createDataFrame([("cd", 1, "DNA")], "term string, n int, label string"))
    docs = spark.createDataFrame([(i, f"ab cd {i}") for i in range(3000)], "doc_id long, abstract string")
    spark.conf.unset(ARROW_ROWS)
    found = tagger.tag(docs, dictionary, ["doc_id"], ["abstract"])
    assert int(spark.conf.get(ARROW_ROWS)) <= 1000 and found.count() == 3000
