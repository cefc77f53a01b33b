from __future__ import annotations

import math
import re
import time
from collections import Counter

import pytest
from llm.conftest import ODD, got

from citemill.llm import license_dice, style_tree

SCHEMA = "page_id long, url string, html string, host string, place int, furniture string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, "f") for r in rows], SCHEMA)


def text_of(html):
    return style_tree.main_text(html, {})


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a<b>b</b> c<p>d", "ab c d"),
        ("<body><nav>x</nav><article><header><h1>T</h1></header><p>a &amp;amp; b&nbsp;c</p></article><footer>f</footer>", "T a &amp; b c"),
        ("<div class='content has-sidebar'>in</div><div class='left-sidebar'>out</div><div id=comments>out</div>", "in"),
        ("<script>var a='</p><p>x';</script><style>p{}</style><!-- <p>c</p> --><p>ok", "ok"),
        ("<p>1 < 2 and <3 &lt;b&gt;</p>", "1 < 2 and <3 <b>"),
        ("<a title='x>y'>k</a><img alt=\"a>b\">m", "km"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"),
        ("<div>a<br>b</div>c<hr>d", "a b c d"),
        ("<SCRIPT>x</SCRIPT><P>Up</P>", "Up"),
        ("plain text", "plain text"),
        ("<p>open <b>tag", "open tag"),
        ("<!-- never closed <p>a", ""),
        ("<form><p>x</p></form><aside>y</aside><div class=cookie-notice>z</div>", ""),
        ("", ""),
    ],
)
def test_main_text(html, text):
    assert text_of(html) == text


def test_articles_of_the_pages(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r["page_id"]: r for r in style_tree.extract(table).collect()}
    for r in table.collect():
        # In these pages the article holds headings, paragraphs, <b> and <br> only.
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:h1|p|br)>", re.sub(r"</?b>", "", article))
        import html

        expected = " ".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))
        assert out[r["page_id"]]["text"] == expected
        assert out[r["page_id"]]["n_chars"] == len(expected)


def test_places_that_never_vary_are_furniture(spark):
    site = lambda i: (
        f"<body><div class=top>Welcome to the site</div><div class=body><p>Story {i} of {i * 7}</p><p>More {i * i}</p></div>"
        "<div class=low>All rights kept</div></body>"
    )
    rows = [(i, f"http://a.org/{i}", site(i)) for i in range(20)] + [(99, "http://b.org/1", site(3)), (100, None, None)]
    out = {r["page_id"]: r["text"] for r in style_tree.extract(pages(spark, rows)).collect()}
    assert out[4] == "Story 4 of 28 More 16"
    assert out[99] == "Welcome to the site Story 3 of 21 More 9 All rights kept"  # one page tells nothing
    assert out[100] == ""


@pytest.mark.parametrize("inside", ["article", "div"])
def test_copies_of_a_page_keep_their_text(spark, inside):
    def page(head, story, paragraphs):
        text = "".join(f"<p>Part {k} of {story}</p>" for k in range(paragraphs))
        return f"<body><aside>{head}</aside><{inside}>{text}</{inside}><div class=low>All rights kept</div></body>"

    words = "".join(f" Part {k} of long" for k in range(12)).strip()
    tail = "" if inside == "article" else " All rights kept"
    # Copies that differ only in what is left out, copies in every byte, and a host of copies alone.
    rows = [(i, f"http://a.org/{i}", page(i % 3, "long", 12)) for i in range(20)]
    rows += [(100 + i, f"http://a.org/{100 + i}", page(i, f"story {i}", 3)) for i in range(15)]
    rows += [(200, "http://b.org/x", page(0, "long", 12))] * 5
    rows += [(210 + i, f"http://b.org/{i}", page(i, "long", 12)) for i in range(5)]
    out = {r["page_id"]: r["text"] for r in style_tree.extract(pages(spark, rows)).collect()}
    assert {out[i] for i in range(20)} == {words}
    assert out[104] == "Part 0 of story 4 Part 1 of story 4 Part 2 of story 4"
    assert {out[i] for i in (200, *range(210, 215))} == {words + tail}


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class=sidebar-layout><p>o</p><article><header>T</header><p>a</p></article></div>", "T a"),
        ("<div id=search><div class=widget>w</div><main>m<div class=ad>x</div></main></div>", "m"),
        ("<article>a</article><div class=comments><article class=comment>c</article></div>", "a"),
        ("<nav><main>m</main></nav><p>a</p>", "a"),
    ],
)
def test_classes_never_take_an_article(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize("pages_of_host", [7, 10, 30])
def test_lines_that_articles_share_stay(spark, pages_of_host):
    def page(i):
        return (
            f"<body><div class=top>Welcome</div><article><h2>Abstract</h2><p>Finding {i} of {i * 7}.</p><h2>Methods</h2>"
            f"<ul><li>Same step</li><li>Step {i}</li></ul><p>Funded by the same fund.</p></article><div>All rights kept</div></body>"
        )

    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(pages_of_host)]
    out = {r["page_id"]: r["text"] for r in style_tree.extract(pages(spark, rows)).collect()}
    assert out == {
        i: f"Abstract Finding {i} of {i * 7}. Methods Same step Step {i} Funded by the same fund." for i in range(pages_of_host)
    }


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class='social-history'>kept</div><div class='social-links'>out</div>", "kept"),
        ("<div id='search-results-study'>kept</div><div id='search-box'>out</div><div class='search'>out</div>", "kept"),
        ("<article>a<table class='related'><tr><td>b</td></tr></table><div class='related-posts'>out</div></article>", "a b"),
        ("<article>a</article><div class='user-feedback'>out</div>", "a"),
        ("<p>a</p><div class='feedback'>out</div><div itemprop=comment>out</div><div class='guestbook-7'>out</div>", "a"),
        ("<p class=notice>kept</p><div class=notice>out</div><div class='page-header'>out</div>", "kept"),
    ],
)
def test_ambiguous_names(html, text):
    assert text_of(html) == text


def test_tree_matches_a_plain_count(spark):
    """What the tree takes off, counted page by page in plain Python."""
    def page(i):
        side = "<div><b>Menu</b><i>Home</i></div>" if i % 10 else "<div><b>Menu</b></div>"
        return f"<body>{side}<div><p>Same line</p><p>Line {i}</p><p>{'odd' if i % 2 else 'even'}</p></div></body>"

    n = 12
    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(n)]
    seen = [{}, {}]
    for _, _, html in rows:
        for place, kind, feature in style_tree.features(html):
            if kind != style_tree.BODY:
                seen[kind].setdefault(place, Counter())[feature] += 1
    entropy = lambda c: -sum(k / sum(c.values()) * math.log(k / sum(c.values())) for k in c.values())
    low = {}
    for place in seen[0]:
        m = sum(seen[0][place].values())
        parts = [entropy(seen[kind][place]) / math.log(m) if m > 1 else 1.0 for kind in (0, 1)]
        value = (1 - style_tree.CONTENT_WEIGHT) * parts[0] + style_tree.CONTENT_WEIGHT * parts[1]
        if m >= style_tree.MIN_PAGES and value < style_tree.MIN_IMPORTANCE:
            low[place] = value
    expected = {i: style_tree.main_text(html, low) for i, _, html in rows}
    out = {r["page_id"]: r["text"] for r in style_tree.extract(pages(spark, rows)).collect()}
    assert out == expected and "Same line" not in out[3] and "Line 3" in out[3]


def test_importance_is_the_entropy(spark):
    rows = [("h", 1, 1, f, n) for f, n in ((10, 3), (11, 1))] + [("h", 1, 0, 5, 4)]
    found = style_tree.importance(spark.createDataFrame(rows, "host string, place long, kind int, feature long, n long")).first()
    entropy = -(0.75 * math.log(0.75) + 0.25 * math.log(0.25)) / math.log(4)
    assert found["pages"] == 4 and abs(found["importance"] - style_tree.CONTENT_WEIGHT * entropy) < 1e-9


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "", ""), (2, "x", "<"), (2, "x", "<"), (3, "http://u@h.org:80/p", "<p>" * 3000 + "t")]
    out = got(style_tree.extract(pages(spark, rows)), "page_id", "url", "text", "n_chars")
    assert out == sorted([(1, None, "", 0), (None, "", "", 0), (2, "x", "<", 1), (2, "x", "<", 1), (3, "http://u@h.org:80/p", "t", 1)], key=str)
    assert style_tree.extract(pages(spark, [])).count() == 0


@pytest.mark.parametrize("html", ["<" * 100_000, "<a b='" * 30_000, "<!--" * 30_000, "<p>" * 50_000, "</p>" * 50_000, "<b>" * 20_000 + "</i>" * 20_000, "<script>" * 20_000])
def test_broken_pages_take_linear_time(html):
    began = time.time()
    text_of(html)
    assert time.time() - began < 8


# --- licences -------------------------------------------------------------------------


def dice(a, b):
    grams = []
    for t in (a, b):
        words = re.findall(r"[^\W_]+", t.lower())
        grams.append(Counter(zip(words, words[1:])))
    return 2 * sum((grams[0] & grams[1]).values()) / (sum(grams[0].values()) + sum(grams[1].values()))


def test_lines_match_brute_force(sample):
    out = {r["doc_id"]: r["licenses"] for r in license_dice.licenses(sample).collect()}
    for r in sample.collect():
        names = set()
        for line in r["text"].split("\n"):
            if len(re.findall(r"[^\W_]+", line)) < 2:
                continue
            scores = [(dice(line, t), n) for n, ts in sorted(license_dice.TEMPLATES.items()) for t in ts]
            best = max(scores, key=lambda x: x[0])
            if best[0] >= license_dice.THRESHOLD:
                names.add(best[1])
        assert out[r["doc_id"]] == ",".join(sorted(names))


def test_whole_notices_and_near_ones(spark):
    mit = license_dice.TEMPLATES["MIT"][2]
    wrapped = "Copyright (c) 2020 Someone\n\n" + "\n".join(mit[i : i + 72] for i in range(0, len(mit), 72))
    texts = [
        (1, "prose before\n\n" + mit.replace("Software", "Program") + "\n\nprose after"),
        (2, wrapped.replace("\n", " \n")),
        (3, "Licensed under CC BY-SA 4.0."),
        (4, "this license is a long story about something else entirely"),
        (5, None),
    ]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    out = {r["doc_id"]: r["licenses"] for r in license_dice.licenses(rows).collect()}
    assert out[1] == "MIT"
    assert out[3] == "CC-BY-SA-4.0" and out[4] == out[5] == ""


def test_license_odd_rows(odd, nothing):
    assert license_dice.report(odd).count() == len(ODD)
    assert license_dice.report(nothing).count() == 0


def test_size_bound_never_hides_a_match():
    templates = license_dice.Templates()
    for n in range(1, 400):
        for size, _, _ in templates.rows:
            if 2 * min(n, size) / (n + size) >= templates.threshold:
                assert templates.fits(n, size) and templates.smallest <= n <= templates.largest


LONG = "\n\n".join(f"Story {i} goes on about wind, rain and the {i} old roads of that valley." for i in range(60))
MIT, BSD = license_dice.TEMPLATES["MIT"][2], license_dice.TEMPLATES["BSD-3-Clause"][-1]


@pytest.mark.parametrize(
    ("inside", "name"),
    [
        # As published: three paragraphs; clauses as own paragraphs, with the disclaimer.
        (MIT.replace("The above", "\n\nThe above").replace("THE SOFTWARE IS", "\n\nTHE SOFTWARE IS"), "MIT"),
        (re.sub(r"(\d\. |THIS SOFTWARE)", r"\n\n\1", BSD), "BSD-3-Clause"),
        ("Some words before it " + MIT.replace(" ", "\n") + "\nand others after it, " * 40, "MIT"),
        ("It rained. This project is licensed under the MIT License. Then, after a while, the sun came out.", "MIT"),
    ],
)
def test_notices_inside_longer_texts(inside, name):
    for text in (f"{LONG}\n\n{inside}\n\n{LONG}", f"{LONG} {inside} {LONG}"):
        found = license_dice.scan(text, license_dice.Templates())
        assert [f[0] for f in found] == [name]
        assert all(license_dice.THRESHOLD <= f[1] <= 1 and text[f[2] : f[3]].strip() for f in found)


def test_words_asked_for_follow_from_the_templates():
    own = license_dice.Templates({"X": ["use it as you wish but never sell what you make of it"]})
    assert license_dice.scan("a b c. Use it as you wish, but never sell what you make of it! " + "d e f " * 30, own)
    for templates in (own, license_dice.Templates()):
        for size, _, grams in templates.rows:
            rest = sum(c for g, c in grams.items() if templates.gate.isdisjoint(g))
            assert 2 * rest < templates.threshold * (rest + size)
