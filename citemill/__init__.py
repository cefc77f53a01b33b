"""citemill: a literature-mining toolkit written as Spark DataFrame jobs."""

from citemill.api import (
    Annotate,
    Filter,
    Ner,
    Parser,
    SqlDb,
    TextClassification,
    Translate,
)

__all__ = [
    "Annotate",
    "Filter",
    "Ner",
    "Parser",
    "SqlDb",
    "TextClassification",
    "Translate",
]
