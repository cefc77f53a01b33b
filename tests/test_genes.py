from __future__ import annotations

import re

import pytest

from citemill.api import Translate
from citemill.operators.genes import search_hits, search_proteins, translate_proteins
from citemill.schemas import GENE_REF

HITS = [
    ("p53", 2, "later", "LATER", [("E9",)]),
    ("p53", 1, "tumor protein p53", "TP53", [("E1",)]),
    ("two", 1, "two genes", "TWO", [("E2",), ("E3",)]),
    ("nameless", 1, None, "NL", [("E4",)]),
    ("plain", 1, "no ensembl", "PL", None),
    ("nosymbol", 1, "no symbol", None, []),
]
ROWS = [(1, " P53 "), (2, "two"), (3, "nameless"), (4, "plain"), (5, "nosymbol"), (6, "unknown"), (7, None), (8, "p53")]


def lookup(spark, strict):
    proteins = spark.createDataFrame(ROWS, "row_id int, protein_1_abstract string")
    ref = spark.createDataFrame(HITS, GENE_REF)
    found = translate_proteins(proteins, ref, "row_id", strict)
    return {
        r["row_id"]: (r["SIMILAR_PROTEIN"], r["SIMILAR_ENSEMBL"], r["SIMILAR_GENE_LIST"])
        for r in found.collect()
    }


BOTH = {
    1: ("tumor protein p53", "E1", "TP53"), 8: ("tumor protein p53", "E1", "TP53"),
    4: ("no ensembl", None, "PL"), 5: ("no symbol", None, None),
    6: (None, None, None), 7: (None, None, None),
}


@pytest.mark.parametrize("broadcast", [True, False])
def test_first_hit(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("citemill.shared.fits_broadcast", lambda *a, **k: False)
    assert lookup(spark, False) == BOTH | {2: ("two genes", "E2", "TWO"), 3: (None, "E4", "NL")}


def test_strict(spark):
    assert lookup(spark, True) == BOTH | {2: ("two genes", None, None), 3: (None, None, None)}


GENES = [
    (3, "tumor protein p53", "TP53", ["p53", "antigen NY-CO-13"], [("E3",)]),
    (1, "tumor protein p63", "TP63", ["p53 like protein"], [("E1",)]),
    (2, "protein", "PRO", None, [("E2",)]),
    (5, None, "p53", [None, ""], None),
    (4, "twin", "TWIN", ["twin"], [("E4",)]),
    (0, "twin", "TWIN", [], [("E0",)]),
]
ASKED = ["p53", "protein", "tumor protein", "Protein, TUMOR", "ny co", "twin", "p53 unknown", "--", "", None, "protein"]


def brute_search(name):
    """Gene of a name, by looking at every spelling of every gene."""
    words = {w for w in re.split("[^a-z0-9]+", (name or "").lower()) if w}
    found = []
    for gene, full, symbol, aliases, _ in GENES:
        for kind, form in [(2, symbol), (1, full), *((0, a) for a in aliases or [])]:
            held = {w for w in re.split("[^a-z0-9]+", (form or "").lower()) if w}
            if words and words <= held:
                found.append((-(1000 * len(words) // len(held)), -kind, gene))
    return min(found)[2] if found else None


@pytest.mark.parametrize("broadcast", [True, False])
def test_search_equals_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("citemill.shared.fits_broadcast", lambda *a, **k: False)
    schema = "gene_id int, name string, symbol string, aliases array<string>, ensembl array<struct<gene:string>>"
    proteins = spark.createDataFrame(list(enumerate(ASKED)), "row_id int, protein_1_abstract string")
    found = search_proteins(proteins, spark.createDataFrame(GENES, schema), "row_id").collect()
    symbols = {g[0]: (g[1], g[2]) for g in GENES} | {None: (None, None)}
    assert {r["row_id"]: (r["SIMILAR_PROTEIN"], r["SIMILAR_GENE_LIST"]) for r in found} == {
        i: symbols[brute_search(name)] for i, name in enumerate(ASKED)
    }
    assert [brute_search(n) for n in ASKED[:6]] == [5, 2, 1, 1, 3, 0]


def test_search_of_nothing(spark):
    schema = "gene_id int, name string, symbol string, aliases array<string>, ensembl array<struct<gene:string>>"
    proteins = spark.createDataFrame([(1, "p53")], "row_id int, protein_1_abstract string")
    genes = spark.createDataFrame(GENES, schema)
    assert search_proteins(proteins, genes.limit(0), "row_id").first()["SIMILAR_GENE_LIST"] is None
    assert search_proteins(proteins.limit(0), genes, "row_id").count() == 0


def test_translate_searches_plain_genes(spark, tmp_path):
    schema = "gene_id int, name string, symbol string, aliases array<string>, ensembl array<struct<gene:string>>"
    proteins = spark.createDataFrame([(1, "ny co"), (2, None)], "tab_id int, protein_1_abstract string")
    plain = Translate(spark, spark.createDataFrame(GENES, schema), ranked=False)
    found = plain.translate(proteins, str(tmp_path / "out")).orderBy("tab_id").collect()
    assert [(r["SIMILAR_GENE_LIST"], r["SIMILAR_ENSEMBL"]) for r in found] == [("TP53", "E3"), (None, None)]


def test_no_gene_table_is_broadcast_unmeasured(spark, plan):
    """Beyond the limit the index and the genes are shuffled, however small their files are."""
    genes = [(i, "protein kinase", f"S{i}", ["alias"], [(f"E{i}",)]) for i in range(50)]
    genes = spark.createDataFrame(genes, "gene_id long, name string, symbol string, aliases array<string>, ensembl array<struct<gene:string>>")
    names = spark.createDataFrame([("s7",), ("protein",), ("none",)], "name string")
    spark.conf.set("spark.citemill.broadcastBytes", "1")
    try:
        hits = search_hits(names, genes)
        assert "BroadcastHashJoin" not in plan(hits)
        assert {r["_key"]: r["_hit"]["symbol"] for r in hits.collect()} == {"s7": "S7", "protein": "S0"}
    finally:
        spark.conf.unset("spark.citemill.broadcastBytes")
