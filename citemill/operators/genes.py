"""Protein names to genes: a first-hit lookup in ranked answers, and a search that ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citemill.shared import lookup_join, materialise


def name_key(name: Column) -> Column:
    """Spelling under which a protein name is looked up."""
    return F.lower(F.trim(name))


def first_hits(gene_ref: DataFrame) -> DataFrame:
    """The best-ranked answer of every query; combined before the shuffle."""
    hit = F.struct("name", "symbol", "ensembl")
    return (
        gene_ref.groupBy(name_key(F.col("query")).alias("_key"))
        .agg(F.min_by(hit, "rank").alias("_hit"))
        .where(F.col("_key").isNotNull())
    )


def translate_proteins(
    proteins: DataFrame,
    gene_ref: DataFrame,
    key: str,
    strict_compat: bool = False,
    column: str = "protein_1_abstract",
) -> DataFrame:
    """Add SIMILAR_PROTEIN, SIMILAR_ENSEMBL and SIMILAR_GENE_LIST; keep every row.

    By default the first of several ensembl genes is taken. With
    ``strict_compat=True`` a hit without a name gives nothing, and a hit with
    several ensembl genes gives its name only.
    """
    return with_hits(proteins, first_hits(gene_ref), key, strict_compat, column)


def with_hits(proteins: DataFrame, hits: DataFrame, key: str, strict_compat: bool, column: str) -> DataFrame:
    """Fill the three columns from one hit per spelling (``_key, _hit``)."""
    joined = lookup_join(
        proteins.withColumn("_key", name_key(F.col(column))),
        materialise(hits, "first-hits"),
        ["_key"],
        "left",
        [key],
    )
    name, symbol = F.col("_hit.name"), F.col("_hit.symbol")
    ensembl = F.get("_hit.ensembl", 0)["gene"]
    if strict_compat:
        named = name.isNotNull()
        single = named & (F.coalesce(F.size("_hit.ensembl"), F.lit(0)) <= 1)
        ensembl = F.when(single, ensembl)
        symbol = F.when(single, symbol)
    return joined.select(
        *proteins.columns,
        name.alias("SIMILAR_PROTEIN"),
        ensembl.alias("SIMILAR_ENSEMBL"),
        symbol.alias("SIMILAR_GENE_LIST"),
    )


def words_of(text: Column) -> Column:
    """Distinct words of letters and digits, in lower case."""
    words = F.split(F.lower(text), "[^a-z0-9]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def gene_forms(genes: DataFrame) -> DataFrame:
    """One row per spelling of a gene: symbol (kind 2), name (1), aliases (0)."""
    own = [F.struct(F.lit(kind).alias("kind"), F.col(c).alias("form")) for c, kind in (("name", 1), ("symbol", 2))]
    aliases = F.transform(
        F.coalesce("aliases", F.array().cast("array<string>")),
        lambda a: F.struct(F.lit(0).alias("kind"), a.alias("form")),
    )
    forms = genes.select(
        "gene_id", F.struct("name", "symbol", "ensembl").alias("hit"), F.explode(F.concat(F.array(*own), aliases)).alias("f")
    )
    forms = forms.select("gene_id", "hit", "f.kind", words_of(F.col("f.form")).alias("words"))
    return forms.where(F.size("words") > 0)


def search_hits(names: DataFrame, genes: DataFrame) -> DataFrame:
    """The best gene (``_key, _hit``) of every distinct name in column ``name``.

    A gene answers a name if one of its spellings holds all words of the name.
    The score is the share of the spelling that the name covers, in whole
    thousandths; at equal scores symbols go before names before aliases, then
    the smallest ``gene_id``. Names meet the inverted index at their rarest word
    only, so a frequent word such as "protein" costs no more than the names that
    have no other. A name with a word that no gene has is settled before that.
    """
    forms = materialise(gene_forms(genes), "gene-forms")
    index = forms.select("gene_id", "kind", "words", F.explode("words").alias("word"))
    counts = materialise(index.groupBy("word").agg(F.count("*").alias("forms")), "word-counts")
    asked = names.select(name_key(F.col("name")).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    asked = asked.withColumn("asked", words_of(F.col("_key"))).where(F.size("asked") > 0)
    found = lookup_join(asked.withColumn("word", F.explode("asked")), counts, ["word"], "inner", ["_key"])
    rarest = found.groupBy("_key").agg(
        F.first("asked").alias("asked"),
        F.count("*").alias("known"),
        F.min_by("word", F.struct("forms", "word")).alias("word"),
    )
    rarest = rarest.where(F.col("known") == F.size("asked"))
    rarest = materialise(rarest.drop("known"), "rarest-words")
    met = lookup_join(index, rarest, ["word"], "inner", ["gene_id"]).where(F.size(F.array_except("asked", "words")) == 0)
    score = F.floor(F.size("asked") * 1000 / F.size("words")).cast("int")
    best = met.groupBy("_key").agg(F.min(F.struct((-score).alias("s"), (-F.col("kind")).alias("k"), "gene_id")).alias("best"))
    best = materialise(best.select("_key", "best.gene_id"), "best-genes")
    hits = forms.groupBy("gene_id").agg(F.first("hit").alias("_hit"))
    return best.join(hits.hint("merge"), "gene_id").select("_key", "_hit")


def search_proteins(
    proteins: DataFrame, genes: DataFrame, key: str, strict_compat: bool = False, column: str = "protein_1_abstract"
) -> DataFrame:
    """:func:`translate_proteins` against genes that nobody has ranked.

    ``genes``: ``gene_id, name, symbol, aliases, ensembl``, one row per gene.
    """
    hits = search_hits(proteins.select(F.col(column).alias("name")), genes)
    return with_hits(proteins, hits, key, strict_compat, column)
