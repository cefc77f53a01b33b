"""Scoring predicted entity spans against gold spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.functions.ratios import f_score, precision, recall, span_f, span_ratio
from citemill.operators.tagger import Dictionary, matches, term_statistics, without_overlaps
from citemill.shared import lookup_join, materialise

# The labels that are scored, and the name of their pool.
SCORED_LABELS = ["RADIOTRACER_S", "RADIOTRACER_L"]
POOLED = "RADIOTRACER"


def match_spans(gold: DataFrame, predicted: DataFrame, keys: list[str]) -> DataFrame:
    """Every distinct span with flags tp / fp / fn.

    Equal means same document, start, end and label. Both sides are stacked and
    grouped once, which needs one shuffle and removes duplicates as well.
    """
    exact = [*keys, "start", "end", "label"]
    both = gold.select(*exact, F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(
        predicted.select(*exact, F.lit(0).alias("g"), F.lit(1).alias("p"))
    )
    return (
        both.groupBy(*exact)
        .agg(F.max("g").alias("g"), F.max("p").alias("p"))
        .select(
            *exact,
            (F.col("g") * F.col("p")).alias("tp"),
            (F.col("p") * (1 - F.col("g"))).alias("fp"),
            (F.col("g") * (1 - F.col("p"))).alias("fn"),
        )
    )


def label_counts(matched: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """tp / fp / fn per scored label; null where a label never occurs."""
    wanted = labels or SCORED_LABELS
    totals = (
        matched.where(F.col("label").isin(*wanted))
        .groupBy("label")
        .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn")])
    )
    listed = matched.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(w) for w in wanted])).alias("label")
    )
    return listed.join(totals, "label", "left")


def score_by_label(matched: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """precision / recall / fscore of each label; null for an absent label."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    return (
        label_counts(matched, labels)
        .withColumn("precision", span_ratio(tp, fp))
        .withColumn("recall", span_ratio(tp, fn))
        .withColumn("fscore", span_f(F.col("precision"), F.col("recall")))
    )


def score_pooled(matched: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """One row with the counts of all scored labels taken together."""
    sums = label_counts(matched, labels).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")]
    )
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    return (
        sums.withColumn("precision", precision(tp, fp))
        .withColumn("recall", recall(tp, fn))
        .withColumn("fscore", f_score(F.col("precision"), F.col("recall")))
        .select(F.lit(POOLED).alias("label"), "*")
    )


def score_report(matched: DataFrame) -> DataFrame:
    """One row per scored label and one for their pool."""
    stored = materialise(matched, "matched")
    return score_by_label(stored).unionByName(score_pooled(stored))


def tagger_history(
    train: DataFrame,
    train_spans: DataFrame,
    test: DataFrame,
    test_spans: DataFrame,
    supports: list[int],
    keys: list[str],
    field: str = "abstract",
) -> DataFrame:
    """(iteration, label, metric, value): scores of dictionaries that ask for
    more and more support. ``iteration`` is the support asked for.

    The test texts are scanned once, with the largest dictionary; each smaller
    one takes its part of the matches and settles their overlaps.
    """
    statistics = materialise(term_statistics(train, train_spans, keys, field), "statistics")
    largest = Dictionary.of(statistics.where(F.col("support") >= min(supports)))
    support_of = statistics.select("term", "support")
    found = matches(test, largest, keys, [field])
    found = materialise(lookup_join(found, support_of, ["term"], "inner", [*keys, "start"]), "matches")
    reports = []
    for support in supports:
        predicted = without_overlaps(found.where(F.col("support") >= support), keys)
        report = score_report(match_spans(test_spans, predicted, keys))
        reports.append(
            report.unpivot("label", ["precision", "recall", "fscore"], "metric", "value").select(
                F.lit(support).alias("iteration"), "label", "metric", "value"
            )
        )
    history = reports[0]
    for report in reports[1:]:
        history = history.unionByName(report)
    return history
