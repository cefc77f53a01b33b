"""Classes that run the steps of the workflow on a Spark session.

parse -> filter -> load into a table -> annotate -> translate, plus training
and evaluation of the two models. Each method is a short job made of the
operators; use those directly for anything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citemill.operators import classify, evaluate, genes, span_scores, tagger
from citemill.operators.annotate import annotate
from citemill.operators.logistic import LogisticModel
from citemill.plans.filter_corpus import Scorer, filter_articles, naive_bayes_scorer
from citemill.schemas import ANNOTATED_COLUMNS, LOAD_EXTRAS
from citemill.shared import materialise
from citemill.sources import article_parquet, article_xml, labelled, tables


class Parser:
    """Article XML files to one parquet dataset."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def parse(
        self, data_path: str, output_path: str, include_deleted: bool = False
    ) -> DataFrame:
        """Parse all intact files below ``data_path`` into ``output_path``."""
        articles = article_xml.read_articles(self.spark, data_path, include_deleted)
        articles.write.mode("overwrite").parquet(output_path)
        return article_parquet.read_article_parquet(self.spark, output_path)


class Filter:
    """Keep the articles a document classifier calls positive.

    ``model`` is the folder of a saved naive Bayes model, or any scorer: a
    function from (file, row_idx, pmid, abstract) rows to rows that also
    have a ``score``. The file is known by its full path.
    """

    def __init__(self, spark: SparkSession, model: str | Scorer):
        self.spark = spark
        if isinstance(model, str):
            model = naive_bayes_scorer(classify.NaiveBayesModel.load(spark, model))
        self.scorer = model

    def filter(self, input_path: str, output_path: str, max_lines: int = -1) -> DataFrame:
        """Filter the files of ``input_path`` that have no result yet."""
        inputs = article_parquet.read_article_parquet(self.spark, input_path)
        done = article_parquet.finished_files(self.spark, output_path)
        todo = article_parquet.remaining(inputs, done, ["row_idx"])
        key = article_parquet.file_key(todo)
        files = materialise(todo.select(key).distinct(), "new-files")
        if not files.isEmpty():
            kept = filter_articles(todo, self.scorer, max_lines)
            article_parquet.append_run(kept, files, output_path)
        return article_parquet.read_kept(self.spark, output_path)


class SqlDb:
    """Kept articles to a catalog table with dense ids."""

    def __init__(self, spark: SparkSession, kept: str | DataFrame, database: str | None = None):
        """``kept`` is a filter output folder or any table of kept articles."""
        self.spark = spark
        self.kept = article_parquet.read_kept(spark, kept) if isinstance(kept, str) else kept
        if database:
            spark.catalog.setCurrentDatabase(database)

    def create_table(
        self, name: str = "articles", path: str | None = None, buckets: int = 0
    ) -> bool:
        """An empty table of text columns and a ``tab_id``; no-op if it exists."""
        extras = [c for c in LOAD_EXTRAS if c not in self.kept.columns]
        fields = [T.StructField("tab_id", T.LongType())]
        fields += [T.StructField(c, T.StringType()) for c in [*self.kept.columns, *extras]]
        return tables.create_table(self.spark, name, T.StructType(fields), path, buckets)

    def fill_table(self, name: str = "articles", distinct_pmids: bool = False) -> bool:
        return tables.fill_table(self.kept, name, distinct_pmids)


class Annotate:
    """Entities of a loaded table's abstracts and titles, one wide row each."""

    def __init__(
        self,
        spark: SparkSession,
        model: str | tagger.Dictionary,
        query_table: str = "articles",
    ):
        self.spark = spark
        self.query_table = query_table
        self.dictionary = (
            tagger.Dictionary.load(spark, model) if isinstance(model, str) else model
        )

    def table_list(self) -> list[str]:
        return tables.table_names(self.spark)

    def create_table(
        self, output_name: str = "articles_ann", path: str | None = None, buckets: int = 0
    ) -> bool:
        fields = [
            T.StructField(c, T.LongType() if c == "tab_id" else T.StringType())
            for c in ANNOTATED_COLUMNS
        ]
        return tables.create_table(self.spark, output_name, T.StructType(fields), path, buckets)

    def annotate(self, output_name: str = "articles_ann", strict_compat: bool = False) -> bool:
        """Annotate the rows whose id is not in the output table yet; only these are tagged."""
        rows = self.spark.table(self.query_table)
        if self.spark.catalog.tableExists(output_name):
            rows = rows.join(self.spark.table(output_name).select("tab_id"), "tab_id", "left_anti")
        return tables.insert_ignore(
            annotate(rows, self.dictionary, "tab_id", strict_compat), output_name
        )


class Translate:
    """Genes of the proteins in an annotated table.

    ``gene_ref`` holds ranked answers (``query, rank, ...``), or with ``ranked=False``
    plain genes (``gene_id, name, symbol, aliases, ensembl``) that are searched.
    """

    def __init__(self, spark: SparkSession, gene_ref: DataFrame, ranked: bool = True):
        self.spark = spark
        self.gene_ref = gene_ref
        self.lookup = genes.translate_proteins if ranked else genes.search_proteins

    def translate(
        self, annotated: DataFrame, output_path: str, key: str = "tab_id",
        strict_compat: bool = False,
    ) -> DataFrame:
        """Write the table with its three gene columns and read it back."""
        self.lookup(annotated, self.gene_ref, key, strict_compat).write.mode(
            "overwrite"
        ).parquet(output_path)
        return self.spark.read.parquet(output_path)


def _numbered(examples: DataFrame, name: str) -> DataFrame:
    """Give examples an id and store them, which fixes the ids."""
    return materialise(examples.withColumn("doc_id", F.monotonically_increasing_id()), name)


class TextClassification:
    """Training and evaluation of a document classifier.

    ``method`` is ``bayes`` (naive Bayes by counting) or ``logistic`` (on hashed terms).
    """

    def __init__(self, spark: SparkSession, method: str = "bayes"):
        if method not in ("bayes", "logistic"):
            raise ValueError(f"unknown method {method}")
        self.spark = spark
        self.method = method
        self.train_data: DataFrame | None = None
        self.test_data: DataFrame | None = None
        self.model: classify.NaiveBayesModel | LogisticModel | None = None

    def load_train_data(self, input_path: str) -> None:
        self.train_data = _numbered(labelled.read_cats(self.spark, input_path), "train")

    def load_test_data(self, input_path: str) -> None:
        self.test_data = _numbered(labelled.read_cats(self.spark, input_path), "test")

    def train(self, n_iter: int = 10) -> None:
        if self.method == "bayes":
            self.model = classify.train_naive_bayes(self.train_data)
        else:
            self.model = classify.train_logistic(self.train_data, max_iter=n_iter)

    def history(self, checkpoints: list[int]) -> DataFrame:
        """Losses and test metrics of the logistic model along its iterations."""
        return evaluate.metric_history(self.train_data, self.test_data, checkpoints)

    def score(self, examples: DataFrame) -> DataFrame:
        """(doc_id, score, cats) of labelled examples."""
        if self.method == "bayes":
            scored = classify.score_naive_bayes(examples, self.model, ["doc_id"], "text")
            return scored.join(examples.select("doc_id", "cats"), "doc_id")
        scored = classify.score_logistic(examples, self.model, "text")
        return scored.select("doc_id", "score", "cats")

    def evaluate(self, threshold: float = 0.5) -> DataFrame:
        return evaluate.confusion(self.score(self.test_data), threshold)

    def get_roc_auc(self, delta_thr: float = 0.01) -> tuple[float, list[float], list[float]]:
        """Area, false and true positive rates; the curve has 1/delta + 1 points."""
        curve = materialise(evaluate.roc_curve(self.score(self.test_data), delta_thr), "curve")
        points = curve.orderBy("point").collect()
        area = evaluate.trapezoid_auc(curve).first()["auc"]
        return area, [p["fpr"] for p in points], [p["tpr"] for p in points]

    def get_auc_Nsq(self, s_frac: float = 1.0, seed: int = 0) -> float | None:
        """Pair-counting area (a tie counts 1)."""
        return evaluate.pair_auc(self.score(self.test_data), s_frac, seed).first()["auc"]

    def get_auc_Nlog2N(self) -> float | None:
        """Rank-based area (a tie counts one half)."""
        return evaluate.rank_auc(self.score(self.test_data), 0.5).first()["auc"]

    def savemodel(self, output_path: str) -> None:
        if self.method == "bayes":
            self.model.save(output_path)
        else:
            self.model.save(self.spark, output_path)


class Ner:
    """Learning and evaluation of an entity dictionary."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.train_data: DataFrame | None = None
        self.test_data: DataFrame | None = None
        self.dictionary: tagger.Dictionary | None = None

    def load_train_data(self, input_path: str) -> None:
        self.train_data = _numbered(labelled.read_entities(self.spark, input_path), "train")

    def load_test_data(self, input_path: str) -> None:
        self.test_data = _numbered(labelled.read_entities(self.spark, input_path), "test")

    def train(self, min_support: int = 1, min_precision: float = 0.0) -> None:
        spans = labelled.entity_rows(self.train_data, ["doc_id"])
        self.dictionary = tagger.learn_dictionary(
            self.train_data, spans, ["doc_id"], "text", min_support, min_precision
        )

    def matched(self) -> DataFrame:
        """Test spans with their tp / fp / fn flags."""
        gold = labelled.entity_rows(self.test_data, ["doc_id"])
        predicted = tagger.tag(self.test_data, self.dictionary, ["doc_id"], ["text"])
        return span_scores.match_spans(gold, predicted, ["doc_id"])

    def evaluate(self) -> DataFrame:
        """precision / recall / fscore per scored label and pooled."""
        return span_scores.score_report(self.matched())

    def history(self, supports: list[int]) -> DataFrame:
        """Test scores of dictionaries learned with different supports."""
        return span_scores.tagger_history(
            self.train_data, labelled.entity_rows(self.train_data, ["doc_id"]),
            self.test_data, labelled.entity_rows(self.test_data, ["doc_id"]),
            supports, ["doc_id"], "text",
        )

    def savemodel(self, output_path: str) -> None:
        self.dictionary.save(output_path)
