"""The operators as queries over the shared tables: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citemill.llm import (
    chat_examples,
    edit_tokens,
    gear_chunks,
    lexical_search,
    license_dice,
    ngram_rtree,
    packing,
    pii,
    quality_bands,
    style_tree,
    suffix_groups,
    whitening,
    winnowing,
)
from citemill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file, which every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_compression_bands(spark, sf_dir):
    return quality_bands.score(table(spark, sf_dir, "documents"))


@query
def op2_edit_counts(spark, sf_dir):
    return edit_tokens.apply_listed(edit_tokens.revisions(table(spark, sf_dir, "documents")), tokenizer_file())


@query
def op3_checked_pii(spark, sf_dir):
    return pii.digest(table(spark, sf_dir, "documents"))


@query
def op4_style_tree(spark, sf_dir):
    return style_tree.extract(table(spark, sf_dir, "pages"))


@query
def op5_count_rtree(spark, sf_dir):
    return ngram_rtree.digest(table(spark, sf_dir, "documents"))


@query
def op6_tier_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op7_suffix_groups(spark, sf_dir):
    return suffix_groups.digest(table(spark, sf_dir, "documents"))


@query
def op8_gear_chunks(spark, sf_dir):
    return gear_chunks.report(table(spark, sf_dir, "documents"))


@query
def op9_license_dice(spark, sf_dir):
    return license_dice.report(table(spark, sf_dir, "documents"))


@query
def op10_winnowing(spark, sf_dir):
    return winnowing.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_jacobi_davidson(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_blocked_products(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_prefix_targets(spark, sf_dir):
    rows = chat_examples.with_probe(spark, table(spark, sf_dir, "conversations"))
    return chat_examples.digest(chat_examples.examples(rows))
