"""Classify a corpus and keep the relevant articles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.operators.classify import NaiveBayesModel, score_naive_bayes
from citemill.operators.gates import eligible, passes_score
from citemill.operators.select import cap_per_file, last_wins
from citemill.shared import lookup_join, materialise
from citemill.sources.article_parquet import row_key

Scorer = Callable[[DataFrame], DataFrame]


def naive_bayes_scorer(model: NaiveBayesModel) -> Scorer:
    """Scorer for :func:`filter_articles` backed by a naive Bayes model."""

    def score(docs: DataFrame) -> DataFrame:
        return score_naive_bayes(docs, model, [*row_key(docs), "pmid"])

    return score


def filter_articles(
    articles: DataFrame, scorer: Scorer, max_lines: int = -1, exact_cap: bool = False
) -> DataFrame:
    """Kept articles with ``class_value``: gate, score, gate, cap, last wins."""
    return selected(articles, passing(articles, scorer), max_lines, exact_cap)


def passing(articles: DataFrame, scorer: Scorer) -> DataFrame:
    """(file, row, pmid, class_value) of the articles that pass both gates, stored."""
    row = row_key(articles)
    scored = scorer(eligible(articles).select(*row, "pmid", "abstract"))
    return materialise(passes_score(scored).select(*row, "pmid", F.col("score").alias("class_value")), "passed")


def selected(articles: DataFrame, passed: DataFrame, max_lines: int = -1, exact_cap: bool = False) -> DataFrame:
    """The articles that cap and last-wins leave of those that passed.

    Only (file, row, pmid, score) goes through the selection. The wide
    columns are read again for the kept rows alone; the list of kept rows is
    stored first, so its size decides whether it is broadcast to that scan.
    """
    row = row_key(articles)
    capped = cap_per_file(passed, max_lines, exact_cap, file=row[0])
    survivors = last_wins(capped, row[0]).select(*row)
    # Narrow rows, as many as are kept: never a broadcast.
    kept = materialise(
        passed.join(survivors.hint("merge"), row).select(*row, "class_value"), "kept"
    )
    return lookup_join(articles, kept, row, "inner", [])
