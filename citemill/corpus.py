"""The article view of the shared test tables, used by queries, bench and tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citemill.functions.text import preprocess_text
from citemill.operators.tagger import Dictionary
from citemill.schemas import ENTITY_LABELS, NEGATIVE, POSITIVE
from citemill.shared import lookup_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Give a plain scan as many partitions as there are cores, if it has fewer.

    A table of many files is left as it is; a table that sits in one small file
    would keep a single core busy.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` laid out for work that is heavy on every text."""
    columns = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return spread(columns, "doc_id")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as articles, scanned as they lie."""
    return as_articles(table(spark, sf_dir, "documents"))


def as_articles(docs: DataFrame) -> DataFrame:
    """``documents`` rows seen as articles that came in eight files."""
    doc_id = F.col("doc_id")
    return docs.select(
        "doc_id",
        doc_id.cast("string").alias("pmid"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"),
        F.col("source").alias("journal"),
        F.lpad((doc_id % 8).cast("string"), 4, "0").alias("file_no"),
        doc_id.alias("row_idx"),
    )


def repeated_pmids(rows: DataFrame) -> DataFrame:
    """Articles renamed so that many share a pmid inside their file."""
    return rows.withColumn("pmid", (F.col("doc_id") % 50).cast("string"))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` as category maps (doc_id, cats)."""
    return table(spark, sf_dir, "labels").select("doc_id", cats().alias("cats"))


def cats() -> Column:
    quality = F.col("quality").cast("double")
    return F.create_map(F.lit(POSITIVE), quality, F.lit(NEGATIVE), 1.0 - quality)


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled training examples (doc_id, text, cats)."""
    texts = documents(spark, sf_dir).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return lookup_join(texts, labels, ["doc_id"], "inner", []).select("doc_id", "text", cats().alias("cats"))


def entity_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary rows (term, n, label) taken from the ``benchmark`` passages.

    Words of six letters or more get a label by their length; neighbouring
    words of five letters or more form a two-word radiotracer.
    """
    words = table(spark, sf_dir, "benchmark").select(
        F.array_remove(F.split(preprocess_text(F.col("text")), " "), "").alias("w")
    )
    labels = F.array(*[F.lit(x) for x in ENTITY_LABELS])
    single = words.select(F.explode("w").alias("term")).where(F.length("term") >= 6)
    single = single.select(
        "term",
        F.lit(1).alias("n"),
        F.get(labels, F.length("term") % len(ENTITY_LABELS)).alias("label"),
    )
    pairs = F.zip_with(
        "w",
        F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))),
        lambda a, b: F.when(
            (F.length(a) >= 5) & (F.length(b) >= 5), F.concat_ws(" ", a, b)
        ),
    )
    double = words.select(F.explode(pairs).alias("term")).where(F.col("term").isNotNull())
    double = double.select("term", F.lit(2).alias("n"), F.lit("RADIOTRACER_L").alias("label"))
    return single.unionByName(double).distinct()


def dictionary(spark: SparkSession, sf_dir: str) -> Dictionary:
    return Dictionary.of(entity_terms(spark, sf_dir))


def gene_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as the ranked answers of a gene service."""
    key = F.col("p_partkey")
    gene = lambda part: F.struct(F.concat(F.lit("ENSG"), key, F.lit(part)).alias("gene"))
    nothing = F.array().cast("array<struct<gene:string>>")
    ensembl = (
        F.when(key % 3 == 0, nothing)
        .when(key % 3 == 1, F.array(gene("a")))
        .otherwise(F.array(gene("a"), gene("b")))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("query"),
        key.alias("rank"),
        F.when(key % 11 != 0, F.col("p_type")).alias("name"),
        F.col("p_brand").alias("symbol"),
        ensembl.alias("ensembl"),
    )


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as genes nobody has ranked: types are names, brands symbols, part names aliases."""
    ranked = gene_ref(spark, sf_dir)
    return ranked.select(F.col("rank").alias("gene_id"), "name", "symbol", F.array("query").alias("aliases"), "ensembl")


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One free spelling per line item: a word or all words of a name, a brand, a type with another word, or none."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    line = F.col("l_linenumber")
    mention = (
        F.when(line == 1, F.substring_index("p_name", " ", -1))
        .when(line == 2, F.concat(F.lit(" "), F.upper("p_name")))
        .when(line == 3, F.replace("p_brand", F.lit("#"), F.lit("-")))
        .when(line == 4, F.concat_ws(" / ", "p_type", "p_type"))
        .when(line == 5, F.concat_ws(" ", "p_name", "p_type"))
        .when(line == 6, F.lit("#"))
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey")
    )
    named = lookup_join(lines, part, ["p_partkey"], "left", ["l_orderkey", "l_linenumber"])
    return named.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_id"), mention.alias("protein_1_abstract"))


def proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One protein mention per line item: many rows share a name, some have none."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    mention = (
        F.when(F.col("p_size") > 45, F.lit("unknown"))
        .when(F.col("l_linenumber") != 7, F.concat(F.lit(" "), F.upper("p_name")))
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey")
    )
    named = lookup_join(lines, part, ["p_partkey"], "left", ["l_orderkey", "l_linenumber"])
    return named.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_id"), mention.alias("protein_1_abstract"))


def land_xml(rows: DataFrame, path: str) -> None:
    """Write articles as compressed XML, one folder per journal.

    Stands in for a delivery of article files.
    """
    article = F.struct(
        F.struct(F.col("journal").alias("Title")).alias("Journal"),
        F.col("title").alias("ArticleTitle"),
        F.struct(F.array("abstract").alias("AbstractText")).alias("Abstract"),
    )
    citation = F.struct(F.col("pmid").alias("PMID"), article.alias("Article"))
    rows.select(citation.alias("MedlineCitation"), "journal").write.format("xml").option(
        "rowTag", "PubmedArticle"
    ).option("rootTag", "PubmedArticleSet").option("compression", "gzip").partitionBy(
        "journal"
    ).save(path)
