"""From entity spans to one annotated row per article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citemill.functions.text import none_to_null
from citemill.operators.gates import slot_labels_only
from citemill.operators.tagger import Dictionary, tag, trie_scan
from citemill.schemas import ANNOTATED_COLUMNS, ARTICLE_COLUMNS, SLOTS


def pivot_last(spans: DataFrame, keys: list[str], labels: list[str] | None = None) -> DataFrame:
    """One row per key, one column per label: the last surface in text order."""
    wanted = labels or list(SLOTS)
    return (
        slot_labels_only(spans)
        .groupBy(*keys)
        .pivot("label", wanted)
        .agg(F.max_by("surface", "start"))
    )


def last_surface(field: str, label: str) -> Column:
    """The same choice for one field and label, as an aggregate."""
    mine = (F.col("field") == field) & (F.col("label") == label)
    return F.max_by(F.when(mine, F.col("surface")), F.when(mine, F.col("start")))


def annotate(
    articles: DataFrame, dictionary: Dictionary, key: str = "tab_id", strict_compat: bool = False
) -> DataFrame:
    """The annotated table: article columns and ten entity slots.

    Articles without any entity (or without text) keep empty slots.
    ``strict_compat=True`` fills the abstract's cell-line slot from the title,
    as older annotated tables have it. With a dictionary that measures small an
    article's slots are filled in its own row; with a larger one its spans are
    gathered by ``key``.
    """
    columns = [none_to_null(F.col(c)).alias(c) for c in ARTICLE_COLUMNS]

    def sources():
        for field in ("abstract", "title"):
            for label, slot in SLOTS.items():
                yield "title" if strict_compat and label == "CELL_LINE" else field, label, f"{slot}_{field}"

    if dictionary.lengths and dictionary.is_small():
        scan = trie_scan(articles, dictionary, True)
        rows = articles.select(key, *columns, *[scan(F.col(f)).alias(f"_{f}") for f in ("abstract", "title")])

        def last(field: str, label: str) -> Column:
            mine = F.filter(f"_{field}", lambda s: s["label"] == label)
            return F.try_element_at(mine, F.lit(-1))["surface"]

        slots = [none_to_null(last(field, label)).alias(slot) for field, label, slot in sources()]
        return rows.select(key, *ARTICLE_COLUMNS, *slots)
    texts = articles.select(key, "abstract", "title")
    spans = slot_labels_only(tag(texts, dictionary, [key], ["abstract", "title"]))
    slots = [none_to_null(last_surface(field, label)).alias(slot) for field, label, slot in sources()]
    wide = articles.select(key, *columns).join(spans.groupBy(key).agg(*slots), key, "left")
    return wide.select(key, *ANNOTATED_COLUMNS[1:])
