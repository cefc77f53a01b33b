from __future__ import annotations

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from citemill.functions.text import REMOVED_PUNCTUATION, WORD_SPACES
from citemill.operators import span_scores, tagger
from citemill.operators.annotate import annotate, pivot_last
from citemill.operators.gates import co_mentions
from citemill.schemas import ANNOTATED_COLUMNS

TERMS = [
    ("fdg", 1, "RADIOTRACER_S"), ("18f fdg", 2, "RADIOTRACER_L"), ("fdg pet scan", 3, "RADIOTRACER_L"),
    ("p53", 1, "PROTEIN"), ("brca1", 1, "DNA"), ("hela", 1, "CELL_LINE"), ("mrna", 1, "RNA"),
    ("scan hela", 2, "CELL_LINE"),
]


@pytest.fixture(scope="module")
def dictionary(spark):
    return tagger.Dictionary.of(spark.createDataFrame(TERMS, "term string, n int, label string"))


def brute(text: str) -> list[tuple]:
    """Leftmost-longest by scanning words one by one."""
    labels = {t: label for t, _, label in TERMS}
    found = [
        (m.start(), re.sub(f"[{re.escape(REMOVED_PUNCTUATION)}]", "", m.group().lower()), m.group())
        for m in re.finditer(f"[^{WORD_SPACES}]+", text)
    ]
    out, i = [], 0
    while i < len(found):
        for n in (3, 2, 1):
            part = found[i : i + n]
            term = " ".join(w[1] for w in part)
            if len(part) == n and term in labels:
                raw = text[part[0][0] : part[-1][0] + len(part[-1][2])]
                surface = raw.strip(REMOVED_PUNCTUATION)
                start = part[0][0] + len(raw) - len(raw.lstrip(REMOVED_PUNCTUATION))
                out.append((start, start + len(surface), labels[term], surface))
                i += n
                break
        else:
            i += 1
    return out


def tag(spark, dictionary, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, abstract string")
    tagged = tagger.tag(docs, dictionary, ["doc_id"], ["abstract"])
    got: dict[int, list] = {i: [] for i in range(len(texts))}
    for r in tagged.orderBy("doc_id", "start").collect():
        got[r["doc_id"]].append((r["start"], r["end"], r["label"], r["surface"]))
    return got


CASES = [
    "", "   ", "nothing here", "FDG", "the 18F FDG, and fdg.", "18F\n\tFDG PET scan HeLa!", "(FDG)",
    "... p53 ...", "fdg pet scan hela", "18f fdg pet scan", "İ p53 é BRCA1", "p.53 \U0001f600 p53",
    None, "18F ... FDG", " HeLa\r\nmRNA",
]


def test_tags_equal_brute_force(spark, dictionary):
    got = tag(spark, dictionary, CASES)
    assert got == {i: brute(t) if t else [] for i, t in enumerate(CASES)}


def test_random_and_long_texts(spark, dictionary):
    rnd = random.Random(5)
    words = ["18F", "FDG", "pet", "scan", "HeLa,", "x", "(p53)", "...", "é"]
    spaces = [" ", "  ", "\n", "\t ", "\r\n"]
    texts = [
        "".join(rnd.choice(words) + rnd.choice(spaces) for _ in range(n)) for n in [*range(60), 40000]
    ]
    assert tag(spark, dictionary, texts) == {i: brute(t) for i, t in enumerate(texts)}


def test_large_dictionary_is_joined_salted(spark, dictionary, monkeypatch):
    monkeypatch.setattr("citemill.shared.fits_broadcast", lambda *a, **k: False)
    assert tag(spark, dictionary, CASES) == {i: brute(t) if t else [] for i, t in enumerate(CASES)}


def test_empty_dictionary(spark):
    empty = tagger.Dictionary.of(spark.createDataFrame([], "term string, n int, label string"))
    assert tag(spark, empty, ["FDG"]) == {0: []}


def test_pivot_last_wins(spark):
    spans = spark.createDataFrame(
        [(1, 0, "PROTEIN", "a"), (1, 9, "PROTEIN", "b"), (1, 3, "RNA", "c"), (2, 1, "DNA", "d")],
        "doc_id int, start int, label string, surface string",
    )
    got = pivot_last(spans, ["doc_id"]).orderBy("doc_id").collect()
    assert got[0]["PROTEIN"] == "b" and got[0]["DNA"] is None and got[1]["DNA"] == "d"
    assert "RNA" not in got[0].asDict()


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(
        [
            (1, "HeLa and FDG", "p53 then P53, FDG; hela", "None", "11"),
            (2, None, "brca1", "J", "12"),
            (3, "18F FDG", None, "J", "13"),
            (4, "x", "nothing", "J", "14"),
        ],
        "tab_id long, title string, abstract string, journal string, pmid string",
    )


def test_annotated_rows(spark, dictionary, articles):
    table = annotate(articles, dictionary)
    assert table.columns == ANNOTATED_COLUMNS
    got = {r["tab_id"]: r for r in table.collect()}
    assert len(got) == 4
    assert got[1]["protein_1_abstract"] == "P53" and got[1]["journal"] is None
    assert got[1]["cell_line_1_abstract"] == "hela" and got[1]["cell_line_1_title"] == "HeLa"
    assert got[2]["title"] is None and got[2]["DNA_1_abstract"] == "brca1"
    assert got[3]["radiotracer_2_title"] == "18F FDG" and got[3]["radiotracer_1_title"] is None
    assert all(got[4][c] is None for c in ANNOTATED_COLUMNS[5:])
    compat = {r["tab_id"]: r for r in annotate(articles, dictionary, strict_compat=True).collect()}
    assert compat[1]["cell_line_1_abstract"] == "HeLa"


def test_co_mentions_by_scope(spark, dictionary, articles):
    table = annotate(articles, dictionary)
    ids = lambda scope: [r["tab_id"] for r in co_mentions(table, scope).collect()]
    assert (ids("either"), ids("abstract"), ids("title")) == ([1], [1], [])


def test_bucketed_table_needs_no_shuffle(spark, dictionary, articles, plan, tmp_path):
    articles.write.bucketBy(4, "tab_id").option("path", str(tmp_path / "t")).saveAsTable("bucketed_articles")
    text = plan(annotate(spark.table("bucketed_articles"), dictionary))
    assert "Exchange hashpartitioning" not in text
    assert annotate(spark.table("bucketed_articles"), dictionary).count() == 4


def test_learned_dictionary(spark):
    docs = spark.createDataFrame(
        [(1, "Foo bar foo"), (2, "foo bar. Foo"), (3, "baz qux"), (4, "baz")], "doc_id int, abstract string"
    )
    spans = spark.createDataFrame(
        [
            (1, "Foo", "DNA"), (1, "foo", "DNA"), (2, "foo", "PROTEIN"), (2, "Foo", "PROTEIN"),
            (1, "bar", "RNA"), (3, "baz  qux", "DNA"), (3, "baz", "DNA"),
        ],
        "doc_id int, surface string, label string",
    )
    got = rows(tagger.term_statistics(docs, spans, ["doc_id"]))
    assert got == [
        ("bar", 1, "RNA", 1, 2, 0.5),
        ("baz", 1, "DNA", 1, 2, 0.5),
        ("baz qux", 2, "DNA", 1, 1, 1.0),
        ("foo", 1, "DNA", 2, 4, 0.5),
    ]
    learned = tagger.learn_dictionary(docs, spans, ["doc_id"], min_support=1, min_precision=0.6)
    assert rows(learned.table) == [("baz qux", 2, "DNA")]


def test_span_scores(spark):
    schema = "doc_id int, start int, end int, label string"
    s, l = "RADIOTRACER_S", "RADIOTRACER_L"
    gold = [(1, 0, 3, s), (1, 0, 3, s), (1, 5, 9, s), (2, 0, 4, "RNA")]
    pred = [(1, 0, 3, s), (1, 5, 8, s), (1, 5, 9, l), (2, 0, 4, "RNA")]
    matched = span_scores.match_spans(
        spark.createDataFrame(gold, schema), spark.createDataFrame(pred, schema), ["doc_id"]
    )
    by_label = {r["label"]: r for r in span_scores.score_by_label(matched).collect()}
    assert tuple(by_label[s])[1:4] == (1, 1, 1) and by_label[s]["precision"] == 0.5
    assert by_label[l]["precision"] == 0.0 and by_label[l]["recall"] == 0.0
    pooled = span_scores.score_pooled(matched).first()
    assert (pooled["tp"], pooled["fp"], pooled["fn"]) == (1, 2, 1)
    assert pooled["precision"] == pytest.approx(1 / 3) and pooled["recall"] == pytest.approx(0.5)


def test_absent_label_scores_null(spark):
    schema = "doc_id int, start int, end int, label string"
    empty = spark.createDataFrame([], schema)
    matched = span_scores.match_spans(empty, empty, ["doc_id"])
    assert all(r["precision"] is None for r in span_scores.score_by_label(matched).collect())
    assert span_scores.score_pooled(matched).first()["fscore"] == 0.0
