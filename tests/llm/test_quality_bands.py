from __future__ import annotations

import random
import re
from pydoc_data.topics import topics

import pytest
import zstandard
from llm.conftest import ODD, got, texts_of

from citemill.llm import quality_bands as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 2000 else {
        w for w, n in __import__("collections").Counter(windows).items() if n > 1
    }
    hit = {i + j for i, w in enumerate(windows) if w in twice for j in range(8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    data = text.encode()
    kept = False
    if data and not failed:
        press = zstandard.ZstdCompressor(level=3)
        fits = lambda b: q.in_band(len(b), len(b) / len(press.compress(b)))
        chunks = [data[a:b] for a, b in q.chunk_sizes(len(data))]
        kept = fits(data) and 2 * sum(not fits(c) for c in chunks) <= len(chunks)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed, kept


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_counts_and_verdict_match_brute_force(sample):
    expected = sorted(((i, *brute(t)) for i, t in texts_of(sample)), key=str)
    assert got(q.score(sample), *COLUMNS) == expected


def test_odd_rows(odd):
    expected = sorted(((i, *brute(t)) for i, t in ODD), key=str)
    assert got(q.score(odd), *COLUMNS) == expected


def test_empty_table(nothing):
    assert q.score(nothing).count() == 0
    assert q.keep(nothing).columns == nothing.columns


def test_keep_returns_the_documents_unchanged(sample):
    kept = q.score(sample).filter("kept").select("doc_id")
    out = q.keep(sample)
    assert out.schema == sample.schema
    assert got(out) == got(sample.join(kept, "doc_id", "left_semi").select(sample.columns))


def test_bands_reject_repeats_and_noise(spark):
    import random

    draw = random.Random(3)
    letters = "".join(draw.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(9000))
    noise = " ".join(letters[i : i + 12] for i in range(0, 9000, 12))
    phrase = " ".join(f"{w}{i % 4}" for i in range(900) for w in ("lorem", "ipsum"))
    rows = spark.createDataFrame([(1, noise), (2, phrase)], "doc_id long, text string")
    assert [r["kept"] for r in q.score(rows).orderBy("doc_id").collect()] == [False, False]


def test_chunk_rest_joins_the_last_chunk():
    assert q.chunk_sizes(9000) == [(0, 4096), (4096, 9000)]
    assert q.chunk_sizes(10) == [(0, 10)]
    assert q.chunk_sizes(8192) == [(0, 4096), (4096, 8192)]


ALPHABETS = {
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 501),
    "alphanumeric": ("abcdefghijklmnopqrstuvwxyz0123456789", 1301),
    "a-z": ("abcdefghijklmnopqrstuvwxyz", 3201),
    "hex": ("0123456789abcdef", 6401),
}


@pytest.mark.parametrize("name", ALPHABETS)
def test_random_words_are_rejected_in_every_class_from_a_size_on(name):
    alphabet, smallest = ALPHABETS[name]
    draw = random.Random(name)
    sizes = [n for b, _, _ in q.BANDS[:-1] for n in (b, b + 1) if n >= smallest] + [40000]
    for size in sizes * 3:
        text = ""
        while len(text) < size:
            text += "".join(draw.choices(alphabet, k=draw.randint(3, 9))) + " "
        assert not q.judge([text[:size].encode()])["kept"][0], size


def test_prose_is_not_below_its_band(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(labels, "doc_id", "left_semi")
    texts = [t.encode() for _, t in texts_of(docs)]
    manuals = [re.sub(r"\s+", " ", t).encode() for t in topics.values()]
    texts += [t[i : i + n] for t in manuals for n in (501, 801, 1301, 2201, 3201, 6401) for i in range(0, len(t) - n, n)]
    assert len(texts) > 500
    press = zstandard.ZstdCompressor(level=q.LEVEL)
    for t in texts:
        low = next(low for most, low, _ in q.BANDS if len(t) <= most)
        assert len(t) / len(press.compress(t)) >= low
