"""Binary-classifier evaluation over (score, cats) rows.

Every metric is one aggregation. Curves and areas work on tables that hold one
row per threshold or per distinct score, never on pairs of samples. A sample
whose score is null or NaN has not been judged and counts nowhere.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citemill.functions.ratios import f_score, precision, recall, specificity
from citemill.operators.gates import gold_present, pure_class
from citemill.operators.numbering import number_by_range
from citemill.operators.select import exact_sample
from citemill.schemas import POSITIVE
from citemill.shared import materialise

# Distinct scores one window task may walk through.
BUCKET_SCORES = 1_000_000


def judged(scored: DataFrame) -> DataFrame:
    """The samples that have a score."""
    return scored.where(F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add the four rates to tp / fp / fn / tn columns."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return (
        counts.withColumn("textcat_p", precision(tp, fp))
        .withColumn("textcat_r", recall(tp, fn))
        .withColumn("textcat_f", f_score(F.col("textcat_p"), F.col("textcat_r")))
        .withColumn("textcat_s", specificity(tn, fp))
    )


def confusion(scored: DataFrame, threshold: float = 0.5, label: str = POSITIVE) -> DataFrame:
    """One row: tp, fp, fn, tn and precision, recall, F, specificity."""
    said = F.col("score") >= threshold
    gold = F.element_at("cats", F.lit(label)) >= 0.5
    counts = gold_present(judged(scored), label).agg(
        F.count_if(said & gold).alias("tp"),
        F.count_if(said & ~gold).alias("fp"),
        F.count_if(~said & gold).alias("fn"),
        F.count_if(~said & ~gold).alias("tn"),
    )
    return with_rates(counts)


def roc_curve(scored: DataFrame, delta: float = 0.01, label: str = POSITIVE) -> DataFrame:
    """Points (point, threshold, tpr, fpr) for thresholds 1, 1-delta, ..., 0.

    One pass puts every sample into the bin of the highest threshold it reaches;
    the curve is a running sum over at most ``1/delta + 1`` bins.
    """
    steps = int(1 / delta)
    score = F.col("score")
    guess = F.floor(score * steps)
    # floor(score * steps) can be one off; compare with the thresholds themselves.
    bin_ = (
        F.when((guess + 1) / F.lit(steps) <= score, guess + 1)
        .when(guess / F.lit(steps) > score, guess - 1)
        .otherwise(guess)
    )
    gold = F.element_at("cats", F.lit(label)) >= 0.5
    bins = (
        gold_present(judged(scored), label)
        .groupBy(F.greatest(F.lit(-1), F.least(F.lit(steps), bin_)).cast("int").alias("bin"))
        .agg(F.count_if(gold).alias("p"), F.count_if(~gold).alias("n"))
    )
    grid = scored.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("bin"))
    reached = Window.orderBy(F.desc("bin"))
    everything = reached.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def total(column: str, window) -> F.Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    curve = (
        grid.join(bins, "bin", "left")
        .withColumn("tp", total("p", reached))
        .withColumn("fp", total("n", reached))
        .withColumn("fn", total("p", everything) - F.col("tp"))
        .withColumn("tn", total("n", everything) - F.col("fp"))
        .where(F.col("bin") >= 0)
    )
    return with_rates(curve).select(
        (F.lit(steps) - F.col("bin")).alias("point"),
        (F.col("bin") / F.lit(steps)).alias("threshold"),
        F.col("textcat_r").alias("tpr"),
        (1 - F.col("textcat_s")).alias("fpr"),
    )


def trapezoid_auc(curve: DataFrame) -> DataFrame:
    """Area under the points of :func:`roc_curve`."""
    along = Window.orderBy("point")
    width = F.lead("fpr").over(along) - F.col("fpr")
    height = (F.lead("tpr").over(along) + F.col("tpr")) / 2.0
    areas = curve.select((width * height).alias("area"))
    return areas.agg(F.coalesce(F.sum("area"), F.lit(0.0)).alias("auc"))


def positives_above(scored: DataFrame) -> DataFrame:
    """One row per distinct score of the pure classes: (score, p, n, above).

    ``above`` counts the positives with a higher score. Samples are first
    combined per score. The running sum works inside buckets of scores cut at
    approximate quantiles: where the cuts fall affects balance only, since the
    totals of higher buckets are added exactly.
    """
    pure = judged(scored).select("score", pure_class(F.col("cats")).alias("pos")).where(
        F.col("pos").isNotNull()
    )
    per_score = pure.groupBy("score").agg(
        F.count_if("pos").alias("p"), F.count_if(~F.col("pos")).alias("n")
    )
    return running_total(materialise(per_score, "per-score"), "p", "above")


def running_total(per_score: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``name``, the sum of ``column`` over all higher scores.

    ``per_score`` is a stored table with one row per distinct score. Up to
    ``BUCKET_SCORES`` of them are walked through by one task; more are cut into
    buckets.
    """
    buckets = -(-per_score.count() // BUCKET_SCORES)
    cuts = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(per_score.approxQuantile("score", shares, 0.1 / buckets)))
    bucketed = per_score.withColumn("_bucket", F.lit(0.0))
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        bucketed = Bucketizer(splits=splits, inputCol="score", outputCol="_bucket").transform(
            per_score
        )
    earlier = (Window.unboundedPreceding, -1)
    higher = Window.orderBy(F.desc("_bucket")).rowsBetween(*earlier)
    totals = (
        bucketed.groupBy("_bucket")
        .agg(F.sum(column).alias("_sum"))
        .select("_bucket", F.coalesce(F.sum("_sum").over(higher), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_bucket").orderBy(F.desc("score")).rowsBetween(*earlier)
    seen = F.coalesce(F.sum(column).over(inside), F.lit(0))
    return (
        bucketed.withColumn("_seen", seen)
        .join(F.broadcast(totals), "_bucket")  # at most len(cuts) + 1 rows
        .withColumn(name, F.col("_seen") + F.col("_before"))
        .drop("_bucket", "_seen", "_before")
    )


def rank_by_score(scored: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add ``rank`` = 1, 2, ... by descending score; of equal scores the row
    with the higher ``key``, of any ordered type, comes first. Rows without a
    score (null or NaN) come last.

    Rows are cut into ranges of (score, key), so neither a score that many rows
    share nor keys with large gaps bring more than a range to one task.
    """
    lowest = F.lit(float("-inf"))
    by = F.coalesce(F.nanvl(F.col("score").cast("double"), lowest), lowest)
    ranked = number_by_range(scored.withColumn("_by", by), [F.desc("_by"), F.desc_nulls_last(key)], "rank")
    return ranked.select(*scored.columns, "rank")


def rank_auc(scored: DataFrame, tie: float) -> DataFrame:
    """Share of (positive, negative) pairs in the right order.

    A pair with equal scores counts ``tie``: 1 for the pair-counting area, one
    half for the rank-based area. Null when one of the classes is empty.
    """
    rows = positives_above(scored)
    won = F.col("n").cast("double") * (F.col("above") + F.lit(float(tie)) * F.col("p"))
    sums = rows.agg(
        F.sum(won).alias("won"),
        F.sum("p").cast("double").alias("pos"),
        F.sum("n").cast("double").alias("neg"),
    )
    return sums.select(
        F.try_divide(F.col("won"), F.col("pos") * F.col("neg")).alias("auc")
    )


def pair_auc(
    scored: DataFrame, s_frac: float = 1.0, seed: int = 0, key: str = "doc_id"
) -> DataFrame:
    """Pair-counting area (ties count 1), on an exact-size sample if asked for."""
    if s_frac < 1.0:
        scored = exact_sample(scored, key, s_frac, seed)
    return rank_auc(scored, 1.0)


def metric_history(
    train: DataFrame, test: DataFrame, checkpoints: list[int], features: int = 1 << 18
) -> DataFrame:
    """(iteration, label, metric, value) rows of a logistic regression.

    One fit gives the loss and the model of every iteration, and one scan of the
    test examples their scores at all checkpoints. A checkpoint behind the last
    iteration has the final model.
    """
    from citemill.operators import logistic

    spark, wanted = train.sparkSession, sorted(set(checkpoints))
    path = logistic.fit(train, features, max(wanted))
    losses = [(i, POSITIVE, "losses", float(p.loss)) for i, p in enumerate(path)]
    history = spark.createDataFrame(losses, "iteration int, label string, metric string, value double")
    models = [path[min(i, len(path) - 1)].model for i in wanted]
    each = F.arrays_zip(F.lit(wanted).alias("iteration"), logistic.scores(test, models, "text").alias("score"))
    # The outer form: a plain explode would score again to filter empty arrays.
    scored = test.select("cats", each.alias("s")).select("cats", F.inline_outer("s"))
    said, gold = F.col("score") >= 0.5, F.element_at("cats", F.lit(POSITIVE)) >= 0.5
    counts = (
        gold_present(judged(scored), POSITIVE)
        .groupBy("iteration")
        .agg(
            F.count_if(said & gold).alias("tp"),
            F.count_if(said & ~gold).alias("fp"),
            F.count_if(~said & gold).alias("fn"),
            F.count_if(~said & ~gold).alias("tn"),
        )
    )
    rates = with_rates(counts).select(
        "iteration",
        F.lit(POSITIVE).alias("label"),
        F.stack(
            F.lit(4),
            F.lit("precision"), F.col("textcat_p"),
            F.lit("recall"), F.col("textcat_r"),
            F.lit("fscore"), F.col("textcat_f"),
            F.lit("specificity"), F.col("textcat_s"),
        ).alias("metric", "value"),
    )
    return history.unionByName(rates)
