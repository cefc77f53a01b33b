"""JSON objects keyed by pmid, one object per line or per input file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citemill.functions.text import stem
from citemill.shared import lookup_join, materialise
from citemill.sources.article_parquet import row_key

PLACE = ["file_path", "file_no", "row_idx"]
# Folders of the objects of an input file, and of one of several files with that number.
FILE_FOLDER, SOURCE_FOLDER = "file_no", "source"


def read_keyed_json(
    spark: SparkSession, path: str, article: T.StructType, whole_files: bool = False, entries: bool = False
) -> DataFrame:
    """Rows (file, pmid, ... , class_value) of ``{"pmid": {...}, ...}`` objects.

    Every line is an object; with ``whole_files`` every file is one, which may
    run over several lines. With ``entries`` the files are those of
    :func:`write_keyed_files`, read entry by entry. The key gives the pmid. Text that is no such object
    fails the job. ``row_idx`` keeps the order of the objects of a file, so the
    rows can be loaded into a table.
    """
    fields = [f for f in article.fields if f.name not in ("pmid", *PLACE)]
    if "class_value" not in article.names:
        fields.append(T.StructField("class_value", T.DoubleType()))
    objects = T.MapType(T.StringType(), T.StructType(fields))
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = reader.text(path, wholetext=whole_files).where(F.trim("value") != "")
    if entries:
        # "{", entries that may begin with a comma, "}".
        entry = F.regexp_replace("value", r"^,", "")
        lines = lines.where(~F.col("value").isin("{", "}")).withColumn("value", F.concat(F.lit("{"), entry, F.lit("}")))
    place = F.col("_metadata.file_path")
    folder = F.url_decode(F.regexp_extract(place, f"/{FILE_FOLDER}=([^/]*)/", 1))
    return (
        lines.select(
            place.alias("file_path"),
            F.when(folder != "", folder).otherwise(stem(F.col("_metadata.file_name"))).alias("file_no"),
            F.explode(parsed(F.col("value"), F.from_json("value", objects))).alias("pmid", "article"),
        )
        .withColumn("row_idx", F.monotonically_increasing_id())
        .select(*PLACE, "pmid", "article.*")
    )


def parsed(text: Column, value: Column) -> Column:
    """``value``, or an error that shows the beginning of the text it should come from."""
    shown = F.concat(F.lit("unreadable JSON: "), F.substring(text, 1, 200))
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(shown))


def keyed_lines(articles: DataFrame) -> DataFrame:
    """One ``{"pmid": {...}}`` object per article, in a ``value`` column.

    A line per article keeps files splittable, however many rows a file has.
    """
    body = F.struct(*[c for c in articles.columns if c != "pmid"])
    return articles.select(F.to_json(F.create_map(F.col("pmid"), body)).alias("value"))


def write_keyed_json(articles: DataFrame, path: str, mode: str = "errorifexists") -> None:
    keyed_lines(articles).write.mode(mode).text(path)


def write_keyed_files(
    articles: DataFrame, path: str, files: DataFrame | None = None, mode: str = "errorifexists"
) -> None:
    """One ``{"pmid": {...}, ...}`` object per input file, in row order.

    Every input file gets one file below ``file_no=<number>/source=<hash of its
    path>``. An object is opened, filled entry by entry and closed by the task
    that writes it; the task sorts (and spills) its rows but never holds a file
    in memory. An entry is a line, so what is written can be read line by line
    as well as whole. ``files`` lists the input files (the columns among
    ``file_path, file_no`` that ``articles`` has); those without a kept article
    get an empty object. A pmid that a file holds twice is written twice.
    """
    *file, row = row_key(articles)
    names = list(dict.fromkeys([*file, "file_no"]))
    seen = articles.groupBy(*names).agg(F.min(row).alias("_first"))
    if files is not None:
        seen = seen.unionByName(files.select(*names).distinct(), allowMissingColumns=True)
        seen = seen.groupBy(*names).agg(F.min("_first").alias("_first"))
    seen = materialise(seen, "files")
    source = F.hex(F.xxhash64(*file)).alias(SOURCE_FOLDER)
    order = [FILE_FOLDER, SOURCE_FOLDER, "_part", row]

    def part(rows: DataFrame, number: int, value: Column) -> DataFrame:
        at = F.col(row) if row in rows.columns else F.lit(0)
        return rows.select("file_no", source, F.lit(number).alias("_part"), at.cast("long").alias(row), value.alias("value"))

    body = F.struct(*[c for c in articles.columns if c not in ("pmid", *PLACE)])
    entry = F.to_json(F.create_map(F.coalesce("pmid", F.lit("")), body))
    entry = F.substring(entry, F.lit(2), F.length(entry) - 2)
    comma = F.when(F.col(row) > F.col("_first"), ",").otherwise("")
    placed = lookup_join(articles, seen, names, "inner", [*file, row])
    lines = part(seen, 0, F.lit("{")).unionByName(part(placed, 1, F.concat(comma, entry))).unionByName(part(seen, 2, F.lit("}")))
    ordered = lines.repartition(FILE_FOLDER, SOURCE_FOLDER).sortWithinPartitions(*order)
    out = ordered.select(FILE_FOLDER, SOURCE_FOLDER, "value")
    out.write.mode(mode).partitionBy(FILE_FOLDER, SOURCE_FOLDER).text(path)
