"""Dictionary entity tagger: learning the dictionary and finding spans.

A dictionary has the columns ``term`` (normalised words joined by one space),
``n`` (number of words) and ``label``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citemill import shared
from citemill.functions.text import REMOVED_PUNCTUATION, WORD_SPACES, in_blocks, let
from citemill.operators import term_scan
from citemill.shared import materialise, small_batches


@dataclass
class Dictionary:
    """A stored dictionary table and, per term length in words, the shortest and
    longest term in characters."""

    table: DataFrame
    lengths: dict[int, tuple[int, int]]
    _small: list[bool] = field(default_factory=list, repr=False)
    _trie: list[Broadcast] = field(default_factory=list, repr=False)

    def is_small(self) -> bool:
        """Whether every executor can hold it."""
        if not self._small:
            self._small.append(shared.fits_broadcast(self.table.select("term", "label")))
        return self._small[0]

    def trie(self, spark: SparkSession) -> Broadcast:
        """The dictionary for the scan tasks; only for one that :meth:`is_small`."""
        if not self._trie:
            rows = self.table.select("term", "label").collect()
            trie = term_scan.Trie([r["term"] for r in rows], [r["label"] for r in rows])
            self._trie.append(spark.sparkContext.broadcast(trie))
        return self._trie[0]

    @staticmethod
    def of(table: DataFrame, name: str = "dictionary") -> Dictionary:
        """Store a dictionary and measure it."""
        return Dictionary.stored(materialise(table.select("term", "n", "label"), name))

    @staticmethod
    def stored(table: DataFrame) -> Dictionary:
        """Measure a table that is already stored; one row per term length."""
        chars = F.length("term")
        sizes = table.groupBy("n").agg(F.min(chars).alias("lo"), F.max(chars).alias("hi"))
        return Dictionary(table, {r["n"]: (r["lo"], r["hi"]) for r in sizes.orderBy("n").collect()})

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Dictionary:
        return Dictionary.stored(spark.read.parquet(path))


WORD = f"([^{WORD_SPACES}]+[{WORD_SPACES}]*)"


def word_norm(piece: Column) -> Column:
    """A word as the dictionary spells it: lower case, no removed punctuation."""
    return F.translate(F.lower(piece), WORD_SPACES + REMOVED_PUNCTUATION, "")


SPAN_FIELDS = "start int, end int, label string, surface string, term string"
HIT_FIELDS = "start int, end int, surface string, term string"


def texts_of(docs: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """``keys``, field, text: one row per text column."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    return docs.select(*keys, F.explode(each).alias("t")).select(*keys, "t.field", "t.text")


def scanned(docs: DataFrame, keys: list[str], fields: list[str], scan) -> DataFrame:
    """``keys``, field and the fields of what ``scan`` finds.

    Finds become a column of their own before they are exploded, so that no text
    is carried along. The outer form spares them the filter on the array's size
    that the optimiser derives from a plain one: it would scan again below.
    """
    found = texts_of(docs, keys, fields).select(*keys, "field", scan(F.col("text")).alias("found"))
    return found.select(*keys, "field", F.inline_outer("found")).where(F.col("start").isNotNull())


def trie_scan(docs: DataFrame, dictionary: Dictionary, settle: bool):
    small_batches(docs.sparkSession)
    trie = dictionary.trie(docs.sparkSession)
    return term_scan.scanner(lambda texts: term_scan.trie_spans(trie.value, texts, settle), SPAN_FIELDS)


def probable_hits(
    docs: DataFrame, dictionary: Dictionary, keys: list[str], fields: list[str]
) -> DataFrame:
    """What a Bloom filter of the terms lets pass: ``keys``, field, start, end, surface, term."""
    small_batches(docs.sparkSession)
    bloom = docs.sparkSession.sparkContext.broadcast(term_scan.bloom_of(dictionary.table))
    scan = term_scan.scanner(lambda texts: term_scan.bloom_spans(bloom.value, texts), HIT_FIELDS)
    return scanned(docs, keys, fields, scan)


def matches(
    docs: DataFrame, dictionary: Dictionary, keys: list[str], fields: list[str]
) -> DataFrame:
    """Every dictionary term found in the text columns, overlaps included.

    Columns: ``keys``, field, start, end, label, surface, term. A dictionary that
    measures small is walked as a trie in the scan task. Of a larger one the
    tasks hold a Bloom filter, and what passes it (the matches and about a
    hundredth of all other runs of words that begin like a term) is joined with
    the dictionary, salted. Spaces and punctuation around a match do not belong
    to it.
    """
    columns = [*keys, "field", "start", "end", "label", "surface", "term"]
    if not dictionary.lengths:
        nothing = docs.select(*keys).limit(0)
        return nothing.select(
            *keys, F.lit("").alias("field"), F.lit(0).alias("start"), F.lit(0).alias("end"),
            *[F.lit("").alias(c) for c in ("label", "surface", "term")],
        )
    if dictionary.is_small():
        return scanned(docs, keys, fields, trie_scan(docs, dictionary, False)).select(*columns)
    terms = dictionary.table.select("term", "label")
    hits = probable_hits(docs, dictionary, keys, fields)
    return shared.salted_join(hits, terms, ["term"], "inner", [*keys, "start"]).select(*columns)


def leftmost_longest(candidates: Column) -> Column:
    """Drop overlaps from an array of spans.

    Spans are taken from left to right, the longest first at each start; a span
    that begins before the last taken one ends is skipped. The fold works block
    by block so that its cost stays linear.
    """
    ordered = F.sort_array(
        F.transform(
            candidates,
            lambda s: F.struct(
                s["field"].alias("field"), s["start"].alias("start"), (-s["end"]).alias("neg_end"),
                s["label"].alias("label"), s["surface"].alias("surface"),
            ),
        )
    )

    def end(s: Column) -> Column:
        return -s["neg_end"]

    def take(acc: Column, s: Column) -> Column:
        free = (acc["field"] != s["field"]) | (s["start"] >= acc["end"])
        return F.when(
            free,
            F.struct(
                s["field"].alias("field"), end(s).alias("end"),
                F.concat(acc["kept"], F.array(s)).alias("kept"),
            ),
        ).otherwise(acc)

    def resolve(spans: Column, none: Column) -> Column:
        def state(before: Column) -> Column:
            return F.struct(before["field"].alias("field"), before["end"].alias("end"),
                            none.alias("kept"))

        def take_block(done: Column, part: Column) -> Column:
            block = F.aggregate(part, state(F.element_at(done, -1)), take)
            return F.concat(done, F.array(block))

        begin = F.struct(F.lit("").alias("field"), F.lit(0).alias("end"), none.alias("kept"))
        blocks = F.aggregate(in_blocks(spans), F.array(begin), take_block)
        return F.flatten(F.transform(blocks, lambda b: b["kept"]))

    def resolved(spans: Column) -> Column:
        # An empty array of the right type, made once.
        return let(F.slice(spans, 1, 0), lambda none: resolve(spans, none))

    return F.transform(
        let(ordered, resolved),
        lambda s: F.struct(
            s["field"].alias("field"), s["start"].alias("start"), end(s).alias("end"),
            s["label"].alias("label"), s["surface"].alias("surface"),
        ),
    )


def tag(
    docs: DataFrame, dictionary: Dictionary, keys: list[str], fields: list[str]
) -> DataFrame:
    """One row per entity: ``keys``, field, start, end, label, surface.

    With a dictionary that measures small, overlaps are settled where the text is
    scanned, and nothing is shuffled. Else see :func:`without_overlaps`.
    """
    if dictionary.lengths and dictionary.is_small():
        return scanned(docs, keys, fields, trie_scan(docs, dictionary, True)).drop("term")
    return without_overlaps(matches(docs, dictionary, keys, fields), keys)


def without_overlaps(found: DataFrame, keys: list[str]) -> DataFrame:
    """Matches without those that overlap one before them or a longer one at the same start.

    Matches are sorted inside their document and cut into clusters wherever one
    begins behind the end of all earlier ones. Overlaps lie inside a cluster,
    which is a handful of rows, and are settled there.
    """
    text = [*keys, "field"]
    ordered = Window.partitionBy(*text).orderBy("start", F.desc("end"), "label", "surface")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.coalesce(F.col("start") >= F.col("reached"), F.lit(True)).cast("int")
    clusters = (
        found.withColumn("reached", reached)
        .withColumn("cluster", F.sum(opens).over(so_far))
        .groupBy(*text, "cluster")
        .agg(F.collect_list(F.struct("field", "start", "end", "label", "surface")).alias("hits"))
    )
    return clusters.select(*keys, leftmost_longest(F.col("hits")).alias("spans")).select(
        *keys, F.inline_outer("spans")
    )


def normalise_surface(surface: Column) -> Column:
    """The dictionary spelling of a surface: normalised words, single spaces."""
    pieces = F.regexp_extract_all(surface, F.lit(WORD), F.lit(1))
    return F.array_join(F.transform(pieces, word_norm), " ")


def learn_dictionary(
    docs: DataFrame,
    spans: DataFrame,
    keys: list[str],
    field: str = "abstract",
    min_support: int = 1,
    min_precision: float = 0.0,
) -> Dictionary:
    """Learn a dictionary from labelled spans.

    Every surface gets its most frequent label. A term is kept when it was
    marked ``min_support`` times with that label and when at least
    ``min_precision`` of its occurrences in the texts were so marked.
    """
    return Dictionary.of(
        term_statistics(docs, spans, keys, field)
        .where((F.col("support") >= min_support) & (F.col("precision") >= min_precision))
        .select("term", "n", "label"),
        "learned-dictionary",
    )


def term_statistics(
    docs: DataFrame, spans: DataFrame, keys: list[str], field: str = "abstract"
) -> DataFrame:
    """(term, n, label, support, occurrences, precision) of marked surfaces.

    Equal counts are settled by the label's name.
    """
    counts = (
        spans.select(normalise_surface(F.col("surface")).alias("term"), "label")
        .where(F.col("term") != "")
        .groupBy("term", "label")
        .agg(F.count("*").alias("support"))
    )
    best = counts.groupBy("term").agg(
        F.min(F.struct((-F.col("support")).alias("less"), F.col("label"))).alias("best")
    )
    marked = materialise(
        best.select(
            "term",
            F.size(F.split("term", " ")).alias("n"),
            F.col("best.label").alias("label"),
            (-F.col("best.less")).alias("support"),
        ),
        "marked-terms",
    )
    seen = (
        matches(docs, Dictionary.stored(marked), keys, [field])
        .groupBy("term")
        .agg(F.count("*").alias("occurrences"))
    )
    return marked.join(seen, "term").withColumn(
        "precision", F.col("support") / F.col("occurrences")
    )
