"""Row filters and small projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citemill.functions.text import none_to_null
from citemill.schemas import NEGATIVE, POSITIVE, SLOTS

# An abstract must be longer than this, a score higher than this.
MIN_ABSTRACT = 10
SCORE_GATE = 0.5


def eligible(articles: DataFrame, text: str = "abstract") -> DataFrame:
    """Articles whose raw text is present and long enough."""
    return articles.where(F.col(text).isNotNull() & (F.length(text) > MIN_ABSTRACT))


def passes_score(scored: DataFrame, score: str = "score") -> DataFrame:
    """Strictly above one half."""
    return scored.where(F.col(score) > SCORE_GATE)


def slot_labels_only(spans: DataFrame) -> DataFrame:
    """Spans whose label has a slot in the annotated table."""
    return spans.where(F.col("label").isin(*SLOTS))


def none_columns_to_null(df: DataFrame) -> DataFrame:
    """Stringify every column and read the text ``None`` as null."""
    return df.select(*[none_to_null(F.col(c)).alias(c) for c in df.columns])


def pure_class(cats: Column) -> Column:
    """True / false when exactly one of the two classes is set, else null."""
    pos = F.try_element_at(cats, F.lit(POSITIVE))
    neg = F.try_element_at(cats, F.lit(NEGATIVE))
    return F.when((pos == 1.0) & (neg == 0.0), F.lit(True)).when(
        (pos == 0.0) & (neg == 1.0), F.lit(False)
    )


def gold_present(scored: DataFrame, label: str = POSITIVE) -> DataFrame:
    """Samples whose gold map knows the label."""
    return scored.where(F.map_contains_key("cats", label))


def co_mentions(annotated: DataFrame, scope: str = "either") -> DataFrame:
    """Rows that name a protein or DNA and also a radiotracer.

    ``scope`` says where both have to be found: in the ``abstract``, in the
    ``title``, or in ``either`` of them.
    """
    fields = {"abstract": ["abstract"], "title": ["title"], "either": ["abstract", "title"]}[scope]

    def named(*slots: str) -> Column:
        return F.coalesce(*[F.col(f"{s}_{f}") for s in slots for f in fields]).isNotNull()

    return annotated.where(
        named("protein_1", "DNA_1") & named("radiotracer_1", "radiotracer_2")
    )
