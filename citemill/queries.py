"""Every operator as a query over the shared tables: name -> f(spark, sf_dir)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citemill import corpus
from citemill.functions.text import file_number, preprocess_text, stem
from citemill.operators import classify, evaluate, gates, genes, logistic, select, span_scores, tagger
from citemill.operators.annotate import annotate, pivot_last
from citemill.plans.filter_corpus import filter_articles, naive_bayes_scorer
from citemill.shared import materialise, new_path
from citemill.sources import article_parquet, article_xml, keyed_json, labelled, tables
from citemill.streaming.ingest import filter_new_files, read_filtered

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
CAP = 50
SUPPORTS = [2, 5]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# --- projections, gates and text -------------------------------------------------


@query
def article_projection(spark, sf_dir):
    return corpus.articles(spark, sf_dir).select(
        F.col("doc_id").alias("tab_id"), "title", "abstract", "journal", "pmid"
    )


@query
def eligibility_gate(spark, sf_dir):
    return gates.eligible(corpus.articles(spark, sf_dir)).select("doc_id", "abstract")


@query
def preprocessed_text(spark, sf_dir):
    docs = corpus.table(spark, sf_dir, "documents")
    return docs.select("doc_id", preprocess_text(F.col("text")).alias("clean"))


@query
def file_lineage(spark, sf_dir):
    ending = F.when(F.col("lang") == "en", ".xml.gz").otherwise(".xml")
    number = F.lpad(F.col("doc_id").cast("string"), 4, "0")
    name = F.concat(F.lit("pubmed23n"), number, ending)
    docs = corpus.table(spark, sf_dir, "documents").select("doc_id", name.alias("file_name"))
    return docs.select(
        "doc_id", "file_name", file_number(F.col("file_name")).alias("file_no"),
        stem(F.concat_ws("/", F.lit("in"), "file_name")).alias("stem"),
    )


@query
def none_to_null(spark, sf_dir):
    docs = corpus.table(spark, sf_dir, "documents")
    journal = F.when(F.col("lang") == "fr", "None").otherwise(F.col("source"))
    return gates.none_columns_to_null(docs.select("doc_id", journal.alias("journal"), "n_chars"))


@query
def pure_classes(spark, sf_dir):
    gold = corpus.gold(spark, sf_dir)
    return gold.select("doc_id", gates.pure_class(F.col("cats")).alias("positive"))


# --- classifier ------------------------------------------------------------------


def _model(spark, sf_dir):
    return classify.train_naive_bayes(corpus.examples(spark, sf_dir))


def _scored(spark, sf_dir) -> DataFrame:
    """(doc_id, score) of every eligible article."""
    articles = corpus.as_articles(corpus.documents(spark, sf_dir))
    docs = gates.eligible(articles).select("doc_id", "abstract")
    return classify.score_naive_bayes(docs, _model(spark, sf_dir), ["doc_id"])


def _judged(spark, sf_dir, digits: int | None = None) -> DataFrame:
    """(doc_id, score, cats) of the labelled articles."""
    scored = _scored(spark, sf_dir).join(corpus.gold(spark, sf_dir), "doc_id")
    if digits is not None:
        scored = scored.withColumn("score", F.round("score", digits))
    return scored


@query
def nb_token_weights(spark, sf_dir):
    return _model(spark, sf_dir).weights


@query
def score_documents(spark, sf_dir):
    return _scored(spark, sf_dir)


@query
def score_gate(spark, sf_dir):
    return gates.passes_score(_scored(spark, sf_dir))


@query
def saved_model_scores(spark, sf_dir):
    path = new_path(spark, "model")
    _model(spark, sf_dir).save(path)
    model = classify.NaiveBayesModel.load(spark, path)
    docs = corpus.articles(spark, sf_dir)
    return classify.score_naive_bayes(docs, model, ["pmid"])


@query
def logistic_scores(spark, sf_dir):
    model = classify.train_logistic(corpus.examples(spark, sf_dir))
    docs = gates.eligible(corpus.articles(spark, sf_dir)).select("doc_id", "abstract")
    return classify.score_logistic(docs, model).select("doc_id", "score")


@query
def saved_logistic_change(spark, sf_dir):
    """How far the scores of a saved logistic model are from those of the model as trained."""
    path = new_path(spark, "logistic")
    model = classify.train_logistic(corpus.examples(spark, sf_dir))
    model.save(spark, path)
    docs = gates.eligible(corpus.articles(spark, sf_dir)).select("doc_id", "abstract")
    fresh = classify.score_logistic(docs, model).withColumnRenamed("score", "fresh")
    both = classify.score_logistic(fresh, logistic.LogisticModel.load(spark, path))
    return both.select("doc_id", (F.col("score") - F.col("fresh")).alias("change"), F.col("score").between(0, 1).alias("valid"))


@query
def training_history(spark, sf_dir):
    examples = corpus.examples(spark, sf_dir)
    test = F.col("doc_id") % 5 == 0
    return evaluate.metric_history(examples.where(~test), examples.where(test), [1, 2, 3, 4, 5])


# --- selection -------------------------------------------------------------------


def _passed(spark, sf_dir, articles: DataFrame) -> DataFrame:
    scored = gates.passes_score(_scored(spark, sf_dir))
    return materialise(
        articles.select("doc_id", "file_no", "row_idx", "pmid").join(scored, "doc_id"), "passed"
    )


@query
def cap_per_file(spark, sf_dir):
    passed = _passed(spark, sf_dir, corpus.articles(spark, sf_dir))
    return select.cap_per_file(passed, CAP)


@query
def last_wins_dedup(spark, sf_dir):
    return select.last_wins(corpus.repeated_pmids(corpus.articles(spark, sf_dir)))


@query
def sampled_examples(spark, sf_dir):
    return select.exact_sample(corpus.table(spark, sf_dir, "labels"), "doc_id", 0.5, seed=7)


@query
def keep_articles(spark, sf_dir):
    scorer = naive_bayes_scorer(_model(spark, sf_dir))
    articles = corpus.as_articles(corpus.documents(spark, sf_dir))
    return filter_articles(articles, scorer)


@query
def keep_articles_capped(spark, sf_dir):
    scorer = naive_bayes_scorer(_model(spark, sf_dir))
    articles = corpus.repeated_pmids(corpus.as_articles(corpus.documents(spark, sf_dir)))
    return filter_articles(articles, scorer, max_lines=CAP)


# --- classifier evaluation -------------------------------------------------------


@query
def confusion_metrics(spark, sf_dir):
    result = evaluate.confusion(_judged(spark, sf_dir))
    return rounded(result, "textcat_p", "textcat_r", "textcat_f", "textcat_s")


@query
def roc_curve(spark, sf_dir):
    return rounded(evaluate.roc_curve(_judged(spark, sf_dir)), "threshold", "tpr", "fpr")


@query
def auc_trapezoid(spark, sf_dir):
    curve = evaluate.roc_curve(_judged(spark, sf_dir))
    return rounded(evaluate.trapezoid_auc(curve), "auc")


@query
def auc_pairs_ties_one(spark, sf_dir):
    return rounded(evaluate.pair_auc(_judged(spark, sf_dir, 1)), "auc")


@query
def auc_rank_ties_half(spark, sf_dir):
    return rounded(evaluate.rank_auc(_judged(spark, sf_dir, 1), 0.5), "auc")


@query
def auc_sampled(spark, sf_dir):
    judged = _judged(spark, sf_dir, 1)
    return rounded(evaluate.pair_auc(judged, s_frac=0.5, seed=7), "auc")


@query
def running_positives(spark, sf_dir):
    return evaluate.positives_above(_judged(spark, sf_dir))


@query
def ranked_documents(spark, sf_dir):
    return evaluate.rank_by_score(_judged(spark, sf_dir, 1).select("doc_id", "score"))


# --- entities --------------------------------------------------------------------


def _fields(spark, sf_dir) -> DataFrame:
    docs = corpus.as_articles(corpus.documents(spark, sf_dir))
    return docs.select("doc_id", "abstract", "title")


def _tags(spark, sf_dir) -> DataFrame:
    dictionary = corpus.dictionary(spark, sf_dir)
    return tagger.tag(_fields(spark, sf_dir), dictionary, ["doc_id"], ["abstract", "title"])


@query
def dictionary_matches(spark, sf_dir):
    dictionary = corpus.dictionary(spark, sf_dir)
    fields = ["abstract", "title"]
    return tagger.matches(_fields(spark, sf_dir), dictionary, ["doc_id"], fields)


@query
def tag_entities(spark, sf_dir):
    return _tags(spark, sf_dir)


@query
def saved_dictionary_tags(spark, sf_dir):
    path = new_path(spark, "dictionary")
    corpus.dictionary(spark, sf_dir).save(path)
    dictionary = tagger.Dictionary.load(spark, path)
    return tagger.tag(_fields(spark, sf_dir), dictionary, ["doc_id"], ["abstract", "title"])


@query
def slot_entities(spark, sf_dir):
    return gates.slot_labels_only(_tags(spark, sf_dir))


@query
def entity_pivot_last_wins(spark, sf_dir):
    return pivot_last(_tags(spark, sf_dir), ["doc_id", "field"])


def _numbered_articles(spark, sf_dir) -> DataFrame:
    docs = corpus.as_articles(corpus.documents(spark, sf_dir))
    return docs.withColumnRenamed("doc_id", "tab_id")


@query
def annotate_documents(spark, sf_dir):
    return annotate(_numbered_articles(spark, sf_dir), corpus.dictionary(spark, sf_dir))


@query
def annotate_documents_compat(spark, sf_dir):
    return annotate(
        _numbered_articles(spark, sf_dir), corpus.dictionary(spark, sf_dir), strict_compat=True
    )


@query
def co_mention_rule(spark, sf_dir):
    annotated = annotate(_numbered_articles(spark, sf_dir), corpus.dictionary(spark, sf_dir))
    return gates.co_mentions(annotated)


@query
def co_mention_in_abstract(spark, sf_dir):
    annotated = annotate(_numbered_articles(spark, sf_dir), corpus.dictionary(spark, sf_dir))
    return gates.co_mentions(annotated, "abstract").select("tab_id", "pmid")


def _gold_spans(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    docs = _fields(spark, sf_dir).select("doc_id", "abstract")
    spans = tagger.tag(docs, corpus.dictionary(spark, sf_dir), ["doc_id"], ["abstract"])
    return docs, materialise(spans, "gold-spans")


@query
def learn_dictionary(spark, sf_dir):
    docs, spans = _gold_spans(spark, sf_dir)
    return rounded(tagger.term_statistics(docs, spans, ["doc_id"]), "precision")


def _matched_spans(spark, sf_dir) -> DataFrame:
    """Gold spans against those of a tagger learned from them."""
    docs, spans = _gold_spans(spark, sf_dir)
    learned = tagger.learn_dictionary(
        docs, spans, ["doc_id"], min_support=2, min_precision=0.9
    )
    predicted = tagger.tag(docs, learned, ["doc_id"], ["abstract"])
    return span_scores.match_spans(spans, predicted, ["doc_id"])


@query
def span_matches(spark, sf_dir):
    return _matched_spans(spark, sf_dir)


@query
def span_prf_by_label(spark, sf_dir):
    scores = span_scores.score_by_label(_matched_spans(spark, sf_dir))
    return rounded(scores, "precision", "recall", "fscore")


@query
def span_prf_pooled(spark, sf_dir):
    scores = span_scores.score_pooled(_matched_spans(spark, sf_dir))
    return rounded(scores, "precision", "recall", "fscore")


@query
def tagger_history(spark, sf_dir):
    docs, spans = _gold_spans(spark, sf_dir)
    history = span_scores.tagger_history(docs, spans, docs, spans, SUPPORTS, ["doc_id"])
    return rounded(history, "value")


# --- gene lookup -----------------------------------------------------------------


@query
def gene_lookup_first_hit(spark, sf_dir):
    return genes.translate_proteins(
        corpus.proteins(spark, sf_dir), corpus.gene_ref(spark, sf_dir), "row_id"
    )


@query
def gene_lookup_strict(spark, sf_dir):
    return genes.translate_proteins(
        corpus.proteins(spark, sf_dir), corpus.gene_ref(spark, sf_dir), "row_id",
        strict_compat=True,
    )


@query
def gene_search(spark, sf_dir):
    return genes.search_proteins(corpus.mentions(spark, sf_dir), corpus.genes(spark, sf_dir), "row_id")


# --- sources, sinks and tables ---------------------------------------------------


@query
def xml_roundtrip(spark, sf_dir):
    landed, parsed = new_path(spark, "landed"), new_path(spark, "articles")
    corpus.land_xml(corpus.as_articles(corpus.documents(spark, sf_dir)), landed)
    article_xml.read_articles(spark, landed).write.parquet(parsed)
    back = article_parquet.read_article_parquet(spark, parsed)
    return back.select("pmid", "title", "abstract", "journal")


@query
def reject_corrupt_files(spark, sf_dir):
    landed = new_path(spark, "landed")
    corpus.land_xml(corpus.as_articles(corpus.documents(spark, sf_dir)), landed)
    # The files of one journal are landed again without their end.
    damaged = f"{new_path(spark, 'damaged')}/part.xml"
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{landed}/journal=src3")
    unclosed = lines.where(~F.col("value").contains("</PubmedArticleSet>"))
    unclosed.write.option("compression", "gzip").text(damaged)
    good = [f"{landed}/journal={r['source']}" for r in
            corpus.table(spark, sf_dir, "documents").select("source").distinct().collect()
            if r["source"] != "src3"]
    return article_xml.read_articles(spark, [*good, damaged], pattern="*.gz").select("pmid", "journal")


@query
def parquet_row_order(spark, sf_dir):
    docs = article_parquet.read_article_parquet(spark, f"{sf_dir}/documents.parquet")
    return docs.select("file_no", "row_idx", "doc_id")


@query
def resume_anti_join(spark, sf_dir):
    file_no = F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("file_no")
    inputs = corpus.table(spark, sf_dir, "documents").select(file_no, "doc_id")
    done = corpus.table(spark, sf_dir, "labels").select(file_no)
    return article_parquet.remaining(inputs, done, ["doc_id"])


@query
def keyed_json_source(spark, sf_dir):
    path = new_path(spark, "keyed")
    docs = corpus.articles(spark, sf_dir).select(
        "pmid", "title", "abstract", "journal",
        (F.length("abstract") / 2).alias("class_value"),
    )
    keyed_json.write_keyed_json(docs, path)
    back = keyed_json.read_keyed_json(spark, path, docs.schema)
    # On through the load, which needs the rows' places.
    columns = ["pmid", "title", "abstract", "journal", "class_value"]
    schema = T.StructType([T.StructField("tab_id", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in columns]])
    name = _table_name("keyed")
    tables.create_table(spark, name, schema, new_path(spark, "table"))
    tables.fill_table(materialise(back, "keyed"), name)
    return spark.table(name).select(*columns[:4], F.col("class_value").cast("double"))


@query
def keyed_json_per_file(spark, sf_dir):
    """One object per input file, written and read again."""
    path = new_path(spark, "keyed-files")
    docs = corpus.articles(spark, sf_dir).drop("doc_id").withColumn("class_value", F.length("abstract") / 2)
    keyed_json.write_keyed_files(docs, path)
    back = keyed_json.read_keyed_json(spark, path, docs.schema, entries=True)
    return back.select("file_no", "pmid", "title", "abstract", "journal", "class_value")


@query
def labelled_json_source(spark, sf_dir):
    path = new_path(spark, "labelled")
    labelled.write_cats(corpus.examples(spark, sf_dir), path)
    back = labelled.read_cats(spark, path)
    return back.select(
        "text",
        F.element_at("cats", "POSITIVE_NUCL_MED").alias("positive"),
        F.element_at("cats", "NEGATIVE_NUCL_MED").alias("negative"),
    )


@query
def labelled_list_source(spark, sf_dir):
    """The same examples as a few files of one list each."""
    path = new_path(spark, "labelled-lists")
    labelled.write_cats_lists(corpus.examples(spark, sf_dir), path, 3)
    back = labelled.read_cats(spark, path)
    return back.select(
        "text",
        F.element_at("cats", "POSITIVE_NUCL_MED").alias("positive"),
        F.element_at("cats", "NEGATIVE_NUCL_MED").alias("negative"),
    )


@query
def labelled_spans_source(spark, sf_dir):
    path = new_path(spark, "spans")
    docs, spans = _gold_spans(spark, sf_dir)
    lists = spans.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "label"))).alias("entities")
    )
    labelled.write_entities(
        docs.join(lists, "doc_id").select(F.col("abstract").alias("text"), "entities"), path
    )
    return labelled.entity_rows(labelled.read_entities(spark, path), []).select(
        "start", "end", "label", "surface"
    )


def _table_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


@query
def load_with_surrogate_id(spark, sf_dir):
    kept = keep_articles(spark, sf_dir)
    columns = ["tab_id", "title", "abstract", "journal", "pmid", "class_value",
               "clean_abstract", "clean_title"]
    schema = T.StructType(
        [T.StructField(c, T.LongType() if c == "tab_id" else T.StringType()) for c in columns]
    )
    name = _table_name("articles")
    tables.create_table(spark, name, schema, new_path(spark, "table"), buckets=8)
    tables.fill_table(kept, name)
    return spark.table(name).withColumn("class_value", F.col("class_value").cast("double"))


@query
def insert_ignore_append(spark, sf_dir):
    docs = annotate(_numbered_articles(spark, sf_dir), corpus.dictionary(spark, sf_dir))
    docs = materialise(docs, "annotated")
    seen = corpus.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("tab_id"))
    name = _table_name("annotated")
    rows = docs.withColumn("load", F.lit("second"))
    tables.create_table(spark, name, rows.schema, new_path(spark, "table"), buckets=8)
    first = docs.join(seen, "tab_id", "left_semi").withColumn("load", F.lit("first"))
    tables.insert_ignore(first, name)
    # Rows that are there already, and others twice in one load.
    tables.insert_ignore(rows.unionByName(rows), name)
    return spark.table(name)


@query
def stream_new_files(spark, sf_dir):
    landed, sink = new_path(spark, "landed"), new_path(spark, "sink")
    checkpoint = new_path(spark, "offsets")
    articles = corpus.articles(spark, sf_dir)
    seen = corpus.table(spark, sf_dir, "labels").select("doc_id")
    scorer = naive_bayes_scorer(_model(spark, sf_dir))
    for landing in ("left_semi", "left_anti"):
        articles.join(seen, "doc_id", landing).write.mode("append").parquet(landed)
        filter_new_files(spark, landed, articles.schema, sink, checkpoint, scorer)
    return read_filtered(spark, sink)


@query
def stream_new_files_capped(spark, sf_dir):
    """Files that arrive in pieces: half of each file's rows in each of two landings."""
    landed, sink = new_path(spark, "landed"), new_path(spark, "sink")
    checkpoint = new_path(spark, "offsets")
    articles = corpus.repeated_pmids(corpus.articles(spark, sf_dir))
    scorer = naive_bayes_scorer(_model(spark, sf_dir))
    for half in (1, 0):
        articles.where((F.col("doc_id") / 8).cast("long") % 2 == half).write.mode("append").parquet(landed)
        filter_new_files(spark, landed, articles.schema, sink, checkpoint, scorer)
    return read_filtered(spark, sink, max_lines=CAP)


def _two_years(spark, sf_dir) -> str:
    """Foreign parquet files in folders of equal names, with equal row numbers, below two years."""
    landed = new_path(spark, "years")
    docs = corpus.articles(spark, sf_dir).drop("file_no", "row_idx")
    for year in (2022, 2023):
        part = docs.where(F.col("doc_id") % 2 == year % 2).withColumn("year", F.lit(year))
        part.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.parquet(f"{landed}/{year}/0001.parquet")
    return landed


@query
def equal_file_names(spark, sf_dir):
    """Articles of both files are kept, each with its own score."""
    landed = _two_years(spark, sf_dir)
    scorer = naive_bayes_scorer(_model(spark, sf_dir))
    paths = [f"{landed}/{y}/0001.parquet" for y in (2022, 2023)]
    articles = article_parquet.numbered(spark.read.parquet(*paths))
    return filter_articles(articles, scorer).select("doc_id", "year", "class_value")


@query
def resume_over_years(spark, sf_dir):
    """The second year is filtered though its file has the first one's name."""
    landed, output = _two_years(spark, sf_dir), new_path(spark, "filtered")
    scorer = naive_bayes_scorer(_model(spark, sf_dir))
    for paths in ([2022], [2022, 2023]):
        folders = [f"{landed}/{y}/0001.parquet" for y in paths]
        inputs = article_parquet.numbered(spark.read.parquet(*folders))
        todo = article_parquet.remaining(inputs, article_parquet.finished_files(spark, output), ["row_idx"])
        files = materialise(todo.select("file_path").distinct(), "new-files")
        article_parquet.append_run(filter_articles(todo, scorer), files, output)
    return article_parquet.read_kept(spark, output).select("doc_id", "class_value")


@query
def ranked_by_text_key(spark, sf_dir):
    scored = _judged(spark, sf_dir, 1).select(F.col("doc_id").cast("string").alias("pmid"), "score")
    return evaluate.rank_by_score(scored, "pmid")


@query
def unscored_samples(spark, sf_dir):
    """Samples without a score count nowhere: one row per metric."""
    judged = _judged(spark, sf_dir, 1)
    score = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("doc_id") % 7 == 1, F.lit(float("nan")))
    judged = judged.withColumn("score", F.coalesce(score, F.when(F.col("doc_id") % 7 > 1, F.col("score"))))
    counts = evaluate.confusion(judged).select((F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"))
    auc = evaluate.pair_auc(judged).select("auc")
    return rounded(counts.crossJoin(auc), "auc")  # one row each


@query
def table_listing(spark, sf_dir):
    """Tables appear in the list when created: a loaded table is listed once."""
    name = _table_name("listed")
    docs = corpus.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("tab_id"))
    tables.create_table(spark, name, docs.schema, new_path(spark, "table"))
    tables.insert_ignore(docs, name)
    listed = [n for n in tables.table_names(spark) if n == name]
    return spark.table(name).agg(F.count("*").alias("rows"), F.lit(len(listed)).cast("bigint").alias("tables"))
