"""Article XML files: reading, flattening and rejecting damaged files."""

from __future__ import annotations

import zlib
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citemill.functions.text import file_number
from citemill.schemas import ARTICLE
from citemill.shared import lookup_join, materialise

ROW_TAG = "PubmedArticle"
CORRUPT = "_corrupt"

# Inline markup that may stand inside a title or an abstract.
INLINE_TAGS = r"</?(i|b|u|sup|sub|sc|mml:[^<>]*|DispFormula[^<>]*)\s*/?>"

# Always declared, never inferred: one title with markup would change its type.
RECORD = f"""
    MedlineCitation STRUCT<
        PMID: STRING,
        Article: STRUCT<
            Journal: STRUCT<
                JournalIssue: STRUCT<
                    Volume: STRING, Issue: STRING,
                    PubDate: STRUCT<Year: STRING, Month: STRING, Day: STRING, MedlineDate: STRING>>,
                Title: STRING>,
            ArticleTitle: STRING,
            Pagination: STRUCT<MedlinePgn: STRING>,
            Abstract: STRUCT<AbstractText: ARRAY<STRING>>,
            AuthorList: STRUCT<Author: ARRAY<STRUCT<
                LastName: STRING, ForeName: STRING,
                AffiliationInfo: ARRAY<STRUCT<Affiliation: STRING>>>>>,
            PublicationTypeList: STRUCT<PublicationType: ARRAY<STRING>>>,
        MedlineJournalInfo: STRUCT<
            Country: STRING, MedlineTA: STRING, NlmUniqueID: STRING, ISSNLinking: STRING>,
        ChemicalList: STRUCT<Chemical: ARRAY<STRUCT<NameOfSubstance: STRING>>>,
        MeshHeadingList: STRUCT<MeshHeading: ARRAY<STRUCT<DescriptorName: STRING>>>,
        KeywordList: STRUCT<Keyword: ARRAY<STRING>>,
        OtherID: ARRAY<STRING>>,
    PubmedData STRUCT<
        ArticleIdList: STRUCT<ArticleId: ARRAY<STRUCT<_IdType: STRING, _VALUE: STRING>>>,
        ReferenceList: STRUCT<Reference: ARRAY<STRUCT<ArticleIdList: STRUCT<
            ArticleId: ARRAY<STRUCT<_IdType: STRING, _VALUE: STRING>>>>>>>,
    {CORRUPT} STRING
"""


def plain(text: Column) -> Column:
    """Text without inline markup."""
    return F.regexp_replace(text, INLINE_TAGS, "")


def listed(items: Column, separator: str = "; ") -> Column:
    joined = F.array_join(items, separator)
    return F.when(joined != "", joined)


# Which files of a folder are read, by the parser and by the check alike.
PATTERN = "*.xml*"


def scan_xml(reader, path: str | list[str], pattern: str = PATTERN) -> DataFrame:
    """Raw records of a batch or stream reader, with file name and position.

    Files of sub-folders belong to it, as they do to :func:`list_files`.
    """
    return (
        reader.format("xml")
        .schema(RECORD)
        .option("rowTag", ROW_TAG)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreCorruptFiles", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(
            "*",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
        )
    )


def flatten(records: DataFrame) -> DataFrame:
    """One flat row per citation, plus the corrupt-record marker.

    Files are compressed and read whole by one task, so the running id keeps
    the order of the records inside each file.
    """
    citation = F.col("MedlineCitation")
    article, journal = citation["Article"], citation["Article"]["Journal"]
    issue, info = journal["JournalIssue"], citation["MedlineJournalInfo"]
    date = issue["PubDate"]
    volume = F.concat_ws("", issue["Volume"], F.concat(F.lit("("), issue["Issue"], F.lit(")")))
    pubmed, authors = F.col("PubmedData"), article["AuthorList"]["Author"]

    def ids(found: Column, kind: str) -> Column:
        chosen = F.filter(found, lambda x: x["_IdType"] == kind)
        return F.transform(chosen, lambda x: x["_VALUE"])

    own = pubmed["ArticleIdList"]["ArticleId"]
    cited = F.flatten(
        F.transform(
            pubmed["ReferenceList"]["Reference"],
            lambda r: F.coalesce(
                ids(r["ArticleIdList"]["ArticleId"], "pubmed"), F.array().cast("array<string>")
            ),
        )
    )
    places = F.flatten(
        F.transform(
            F.filter(authors, lambda a: a["AffiliationInfo"].isNotNull()),
            lambda a: F.transform(a["AffiliationInfo"], lambda i: i["Affiliation"]),
        )
    )
    columns = {
        "title": plain(article["ArticleTitle"]),
        "issue": F.when(volume != "", volume),
        "pages": article["Pagination"]["MedlinePgn"],
        "abstract": plain(F.array_join(article["Abstract"]["AbstractText"], "\n")),
        "journal": journal["Title"],
        "authors": listed(
            F.transform(authors, lambda a: F.concat_ws(" ", a["LastName"], a["ForeName"]))
        ),
        "pubdate": F.coalesce(date["Year"], date["MedlineDate"]),
        "pmid": citation["PMID"],
        "mesh_terms": listed(
            F.transform(citation["MeshHeadingList"]["MeshHeading"], lambda m: m["DescriptorName"])
        ),
        "publication_types": listed(article["PublicationTypeList"]["PublicationType"]),
        "chemical_list": listed(
            F.transform(citation["ChemicalList"]["Chemical"], lambda c: c["NameOfSubstance"])
        ),
        "keywords": listed(citation["KeywordList"]["Keyword"]),
        "doi": F.get(ids(own, "doi"), 0),
        "references": listed(cited),
        "affiliations": listed(places),
        "pmc": F.get(ids(own, "pmc"), 0),
        "other_id": listed(citation["OtherID"]),
        "medline_ta": info["MedlineTA"],
        "nlm_unique_id": info["NlmUniqueID"],
        "issn_linking": info["ISSNLinking"],
        "country": info["Country"],
        "delete": F.lit(False),
        "file_path": F.col("file_path"),
        "file_name": F.col("file_name"),
        "file_no": file_number(F.col("file_name")),
        "row_idx": F.monotonically_increasing_id(),
    }
    return records.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in ARTICLE.fields],
        F.col(CORRUPT).isNotNull().alias(CORRUPT),
    )


def document_intact(content: Column, packed: Column) -> Column:
    """Whether the bytes are one whole XML document, in complete gzip members if packed.

    The built-in readers return the readable half of a truncated file, and the
    closed records of an unclosed document, without a word, so this looks at the
    whole file once, in pieces. A task sees the files of one input split. The
    function is nested so that it travels to the executors by value.
    """

    def unpacked(data: bytes):
        while data:
            member = zlib.decompressobj(wbits=31)
            yield member.decompress(data, 1 << 20)
            while member.unconsumed_tail:
                yield member.decompress(member.unconsumed_tail, 1 << 20)
            if not member.eof:
                raise zlib.error("cut off")
            data = member.unused_data.lstrip(b"\0")

    def intact(data: bytes, gz: bool) -> bool:
        parser = expat.ParserCreate()
        plain = unpacked(data) if gz else (data[i : i + (1 << 20)] for i in range(0, len(data), 1 << 20))
        try:
            for piece in plain:
                parser.Parse(piece, False)
            parser.Parse(b"", True)
        except (zlib.error, expat.ExpatError):
            return False
        return True

    @F.pandas_udf(T.BooleanType())
    def check(files: pd.Series, gz: pd.Series) -> pd.Series:
        return pd.Series([intact(f, g) for f, g in zip(files, gz)], dtype=bool)

    return check(content, packed)


def list_files(spark: SparkSession, path: str | list[str], pattern: str = PATTERN) -> DataFrame:
    """(file_path, content) of every file below ``path``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("_metadata.file_path").alias("file_path"), "content")
    )


def check_files(files: DataFrame) -> DataFrame:
    """(file_path, ok) for rows of (file_path, content)."""
    packed = F.col("file_path").endswith(".gz")
    return files.select("file_path", document_intact(F.col("content"), packed).alias("ok"))


def reject_files(articles: DataFrame, manifest: DataFrame) -> DataFrame:
    """Drop every article of a damaged file, before anything is written.

    The list of damaged files is stored and measured; articles stay where they
    are as long as it is small. A record the reader could not take, though its
    file is well formed, fails the job rather than going missing.
    """
    bad = materialise(manifest.where(~F.col("ok")).select("file_path").distinct(), "bad-files")
    left = lookup_join(articles, bad, ["file_path"], "left_anti", ["row_idx"])
    unread = F.raise_error(F.concat(F.lit("unreadable record in "), F.col("file_path")))
    pmid = F.when(F.col(CORRUPT), unread).otherwise(F.col("pmid"))
    return left.withColumn("pmid", pmid).drop(CORRUPT)


def scan_deleted(reader, path: str | list[str], pattern: str = PATTERN) -> DataFrame:
    """Raw lists of withdrawn articles of a batch or stream reader, with the file's name."""
    return (
        reader.format("xml")
        .schema(f"PMID ARRAY<STRING>, {CORRUPT} STRING")
        .option("rowTag", "DeleteCitation")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreCorruptFiles", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(
            "*",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
        )
    )


def flatten_deleted(records: DataFrame) -> DataFrame:
    """One row per withdrawn article: its pmid, ``delete`` set, the file's columns, nothing else."""
    rows = records.select(
        # A list that can't be read gives one row, which fails the job.
        F.explode_outer("PMID").alias("pmid"),
        F.lit(True).alias("delete"),
        "file_path",
        "file_name",
        file_number(F.col("file_name")).alias("file_no"),
        F.col(CORRUPT).isNotNull().alias(CORRUPT),
        # Behind the articles of the same file.
        (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("row_idx"),
    ).where(F.col("pmid").isNotNull() | F.col(CORRUPT))
    columns = [
        F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in ARTICLE.fields
    ]
    return rows.select(*columns, CORRUPT)


def deleted_citations(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """Withdrawn articles of the files below ``path``.

    Only update files list any, and it takes a pass over the files.
    """
    return flatten_deleted(scan_deleted(spark.read, path, pattern))


def read_articles(
    spark: SparkSession, path: str, include_deleted: bool = False, pattern: str = PATTERN
) -> DataFrame:
    """All articles of the intact XML files below ``path``, sub-folders included.

    Files are checked first, so the articles go from the parser straight to
    whatever reads them; no copy of them is made in between.
    """
    manifest = check_files(list_files(spark, path, pattern))
    records = flatten(scan_xml(spark.read, path, pattern))
    if include_deleted:
        records = records.unionByName(deleted_citations(spark, path, pattern))
    return reject_files(records, manifest)
