"""Document classifiers: training and scoring.

Two scorers share one shape, ``DataFrame -> DataFrame with a score column``:

* a multinomial naive Bayes model, trained by counting and applied by a join;
* a logistic regression on hashed terms, applied row by row without any shuffle.

Any other callable of that shape can take their place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citemill.functions.text import tokens
from citemill.operators import logistic
from citemill.schemas import POSITIVE
from citemill.shared import fits_broadcast, materialise, salted_join

# Weights are stored in millionths, as whole numbers: their sums are exact, so
# a score does not depend on the order in which a shuffle delivers the tokens.
UNIT = 1_000_000
SCORE_DIGITS = 6


@dataclass
class NaiveBayesModel:
    """Token weights (token, pos_n, neg_n, weight) and the prior log-odds."""

    weights: DataFrame
    prior: float

    def save(self, path: str) -> None:
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")
        prior = self.weights.sparkSession.range(1).select(F.lit(self.prior).alias("prior"))
        prior.write.mode("overwrite").parquet(f"{path}/prior")

    @staticmethod
    def load(spark: SparkSession, path: str) -> NaiveBayesModel:
        prior = spark.read.parquet(f"{path}/prior").first()["prior"]
        return NaiveBayesModel(spark.read.parquet(f"{path}/weights"), prior)


def train_naive_bayes(
    examples: DataFrame, alpha: float = 1.0, class_prior: bool = False
) -> NaiveBayesModel:
    """Count tokens per class and turn the counts into smoothed log-odds.

    ``examples`` has ``text`` and ``cats``. Common tokens are combined on the
    map side, so the shuffle carries one row per token and map task. Both
    classes are taken as equally likely unless ``class_prior`` asks for the
    share they have among the examples.
    """
    positive = F.try_element_at("cats", F.lit(POSITIVE)) >= 0.5
    gold = examples.select(tokens(F.col("text")).alias("toks"), positive.alias("pos")).where(
        F.col("pos").isNotNull()
    )
    counts = materialise(
        # The outer form, because the optimiser derives a filter on the token array
        # from a plain explode, and that would tokenise every text again.
        gold.select("pos", F.explode_outer("toks").alias("token"))
        .where(F.col("token") != "")
        .groupBy("token")
        .agg(F.count_if("pos").alias("pos_n"), F.count_if(~F.col("pos")).alias("neg_n")),
        "token-counts",
    )
    total = counts.agg(
        F.count("*").alias("vocab"), F.sum("pos_n").alias("pos"), F.sum("neg_n").alias("neg")
    ).first()
    prior = 0.0
    if class_prior:
        docs = gold.agg(F.count_if("pos").alias("pos"), F.count_if(~F.col("pos")).alias("neg"))
        prior = docs.select(F.ln((F.col("pos") + 1) / (F.col("neg") + 1))).first()[0]

    def share(column: str, seen: int):
        return (F.col(column) + F.lit(alpha)) / F.lit((seen or 0) + alpha * total["vocab"])

    odds = F.ln(share("pos_n", total["pos"]) / share("neg_n", total["neg"]))
    weights = counts.withColumn("weight", F.round(odds * UNIT).cast("bigint"))
    return NaiveBayesModel(weights, prior)


def common_tokens(weights: DataFrame) -> tuple[DataFrame, int]:
    """The tokens seen most often in training, as many as can be broadcast.

    Returns them with the count from which on a token belongs to them; 0 when
    that is the whole model.
    """
    seen = F.col("pos_n") + F.col("neg_n")
    least, common = 0, weights
    while not fits_broadcast(common.select("token", "weight")):
        least = max(2, least * 4)
        if least > 1 << 40:
            return weights.limit(0), least
        common = weights.where(seen >= least)
    return common, least


def score_naive_bayes(
    docs: DataFrame, model: NaiveBayesModel, keys: list[str], text: str = "abstract"
) -> DataFrame:
    """``keys`` and ``score`` in [0, 1], one row per document.

    The score is the logistic of the prior plus the mean weight of the known
    tokens; a plain sum would saturate on long documents. Documents without a
    known token keep the prior.

    Only keys and tokens are exploded. Common tokens meet a broadcast table in
    the scan task and shrink to one partial sum per document before anything is
    shuffled. When the whole model does not fit, the remaining rare tokens are
    counted per document and looked up in a second, salted join.
    """
    exploded = docs.select(*keys, F.explode_outer(tokens(F.col(text))).alias("token"))
    common, least = common_tokens(model.weights)
    hit = exploded.join(F.broadcast(common.select("token", "weight")), "token", "left")
    known = [F.sum("weight").alias("total"), F.count("weight").alias("known")]
    if least == 0:
        sums = hit.groupBy(*keys).agg(*known)
    else:
        rare = F.when(F.col("weight").isNull(), F.nullif("token", F.lit(""))).alias("token")
        partial = hit.groupBy(*keys, rare).agg(*known, F.count("*").alias("times"))
        rest = model.weights.where(F.col("pos_n") + F.col("neg_n") < least)
        looked_up = salted_join(partial, rest.select("token", "weight"), ["token"], "left", keys)
        sums = looked_up.groupBy(*keys).agg(
            F.sum(F.coalesce("total", F.col("weight") * F.col("times"))).alias("total"),
            F.sum(
                F.col("known") + F.when(F.col("weight").isNotNull(), F.col("times")).otherwise(0)
            ).alias("known"),
        )
    mean = F.try_divide(F.col("total") / F.lit(UNIT), F.col("known"))
    score = 1 / (1 + F.exp(-(F.lit(model.prior) + F.coalesce(mean, F.lit(0.0)))))
    return sums.select(*keys, F.round(score, SCORE_DIGITS).alias("score"))


def train_logistic(
    examples: DataFrame, features: int = logistic.FEATURES, max_iter: int = 20, reg: float = 0.01
) -> logistic.LogisticModel:
    """Logistic regression on hashed terms.

    The number of features bounds the model, however large the vocabulary is.
    """
    return logistic.fit(examples, features, max_iter, reg)[-1].model


def score_logistic(
    docs: DataFrame, model: logistic.LogisticModel, text: str = "abstract"
) -> DataFrame:
    """Add ``score`` to whole rows; no shuffle."""
    return docs.withColumn("score", F.get(logistic.scores(docs, [model], text), 0))
