"""Fixed schemas of the corpus tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The two document classes.
POSITIVE = "POSITIVE_NUCL_MED"
NEGATIVE = "NEGATIVE_NUCL_MED"

# Every label the entity tagger may give.
ENTITY_LABELS = [
    "CELL_LINE",
    "CELL_TYPE",
    "DNA",
    "ENTITY",
    "PROTEIN",
    "RADIOTRACER_L",
    "RADIOTRACER_S",
    "RNA",
]

# Label -> name of its slot in the annotated table.
SLOTS = {
    "RADIOTRACER_S": "radiotracer_1",
    "RADIOTRACER_L": "radiotracer_2",
    "PROTEIN": "protein_1",
    "DNA": "DNA_1",
    "CELL_LINE": "cell_line_1",
}

# Article columns the annotated table keeps.
ARTICLE_COLUMNS = ["title", "abstract", "journal", "pmid"]

ANNOTATED_COLUMNS = [
    "tab_id",
    *ARTICLE_COLUMNS,
    *[f"{slot}_{field}" for field in ("abstract", "title") for slot in SLOTS.values()],
]

# Columns added when kept articles are loaded into a table.
LOAD_EXTRAS = ["class_value", "clean_abstract", "clean_title"]


def strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# One parsed article: pass-through citation columns, plus where it came from.
ARTICLE = T.StructType(
    strings(
        "title", "issue", "pages", "abstract", "journal", "authors", "pubdate", "pmid",
        "mesh_terms", "publication_types", "chemical_list", "keywords", "doi", "references",
        "affiliations", "pmc", "other_id", "medline_ta", "nlm_unique_id", "issn_linking", "country",
    )
    + [T.StructField("delete", T.BooleanType())]
    + strings("file_path", "file_name", "file_no")
    + [T.StructField("row_idx", T.LongType())]
)

CATS = T.MapType(T.StringType(), T.DoubleType())

SPAN = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("label", T.StringType()),
    ]
)

# Ranked answers of a gene service, one row per (query, rank).
GENE_REF = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField(
            "ensembl",
            T.ArrayType(T.StructType([T.StructField("gene", T.StringType())])),
        ),
    ]
)
