"""The whole way from files to genes, and the incremental jobs."""

from __future__ import annotations

import gzip
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_sources import citation, document

import citemill
from citemill.operators import classify, tagger
from citemill.plans.filter_corpus import filter_articles, naive_bayes_scorer
from citemill.schemas import ANNOTATED_COLUMNS, GENE_REF, NEGATIVE, POSITIVE
from citemill.streaming.ingest import filter_new_files, parse_new_files, read_filtered, withdraw_new_files

GOOD = "tracer uptake of 18F FDG with p53 in HeLa cells"
BAD = "a survey of dental hygiene among school pupils"


def write_examples(path, repeat=3):
    lines = []
    for text, positive in [(GOOD, True), (BAD, False)] * repeat:
        lines.append([text, {"cats": {POSITIVE: positive, NEGATIVE: not positive}}])
    path.write_text("\n".join(map(json.dumps, lines)))
    return str(path)


def deliver(folder, number, articles):
    folder.mkdir(exist_ok=True)
    data = document(*[citation(p, t, (a,)) for p, t, a in articles])
    (folder / f"pubmed23n{number}.xml.gz").write_bytes(gzip.compress(data))


def test_files_to_genes(spark, tmp_path):
    examples = write_examples(tmp_path / "cats.json")
    classifier = citemill.TextClassification(spark)
    classifier.load_train_data(examples)
    classifier.load_test_data(examples)
    classifier.train()
    assert classifier.evaluate().first()["textcat_f"] == pytest.approx(1.0)
    area, fpr, tpr = classifier.get_roc_auc(0.1)
    assert area == pytest.approx(1.0, abs=1e-6) and len(fpr) == len(tpr) == 11
    assert classifier.get_auc_Nsq() == classifier.get_auc_Nlog2N() == 1.0
    assert classifier.get_auc_Nsq(s_frac=1.0, seed=3) == 1.0
    model = str(tmp_path / "model")
    classifier.savemodel(model)

    incoming = tmp_path / "in"
    deliver(incoming, "0001", [(1, "HeLa", GOOD), (2, "Teeth", BAD), (3, "FDG", GOOD + " again")])
    parsed, filtered = str(tmp_path / "parsed"), str(tmp_path / "filtered")
    parser, keeper = citemill.Parser(spark), citemill.Filter(spark, model)
    assert parser.parse(str(incoming), parsed).count() == 3
    assert rows(keeper.filter(parsed, filtered).select("pmid")) == [("1",), ("3",)]
    deliver(incoming, "0002", [(4, "p53", GOOD + " once more"), (5, "Teeth", BAD)])
    parser.parse(str(incoming), parsed)
    for _ in range(2):
        assert rows(keeper.filter(parsed, filtered).select("pmid")) == [("1",), ("3",), ("4",)]

    db = citemill.SqlDb(spark, filtered)
    assert db.create_table("wf_articles", str(tmp_path / "t1"), buckets=2) and db.fill_table("wf_articles")
    assert rows(spark.table("wf_articles").select("tab_id", "pmid")) == [(1, "1"), (2, "3"), (3, "4")]

    spans = [["x 18F FDG y", {"entities": [[2, 9, "RADIOTRACER_L"]]}], ["p53 in HeLa", {"entities": [[0, 3, "PROTEIN"], [7, 11, "CELL_LINE"]]}],
             ["FDG", {"entities": [[0, 3, "RADIOTRACER_S"]]}]]
    path = tmp_path / "spans.json"
    path.write_text(json.dumps(spans))
    ner = citemill.Ner(spark)
    ner.load_train_data(str(path))
    ner.load_test_data(str(path))
    ner.train()
    scores = {r["label"]: r["fscore"] for r in ner.evaluate().collect()}
    assert scores == pytest.approx({"RADIOTRACER_S": 1.0, "RADIOTRACER_L": 1.0, "RADIOTRACER": 1.0})
    dictionary = str(tmp_path / "dictionary")
    ner.savemodel(dictionary)

    annotator = citemill.Annotate(spark, dictionary, "wf_articles")
    assert annotator.create_table("wf_annotated", str(tmp_path / "t2"), buckets=2)
    for _ in range(2):
        annotator.annotate("wf_annotated")
    annotated = spark.table("wf_annotated")
    assert annotated.columns == ANNOTATED_COLUMNS and annotated.count() == 3
    assert {"wf_articles", "wf_annotated"} <= set(annotator.table_list())
    first = annotated.where("tab_id = 1").first()
    assert first["radiotracer_2_abstract"] == "18F FDG" and first["cell_line_1_title"] == "HeLa"

    ref = spark.createDataFrame([("p53", 1, "tumor protein", "TP53", [("E1",)])], GENE_REF)
    genes = citemill.Translate(spark, ref).translate(annotated, str(tmp_path / "genes"))
    assert {r["SIMILAR_GENE_LIST"] for r in genes.collect()} == {"TP53"}


def test_logistic_model_and_history(spark, tmp_path):
    examples = write_examples(tmp_path / "cats.json", repeat=5)
    classifier = citemill.TextClassification(spark, "logistic")
    classifier.load_train_data(examples)
    classifier.load_test_data(examples)
    classifier.train(n_iter=5)
    classifier.savemodel(str(tmp_path / "lr"))
    assert classifier.evaluate().first()["textcat_f"] == pytest.approx(1.0)
    history = classifier.history([1, 3])
    metrics = {(r["iteration"], r["metric"]) for r in history.collect()}
    assert {(1, "precision"), (3, "fscore"), (0, "losses")} <= metrics


def test_bayes_weights_by_hand(spark):
    data = [(1, "A b b", {POSITIVE: 1.0}), (2, "b, c", {POSITIVE: 0.0}), (3, "zzz", {NEGATIVE: 1.0})]
    examples = spark.createDataFrame(data, "doc_id int, text string, cats map<string,double>")
    model = classify.train_naive_bayes(examples)
    got = {r["token"]: (r["pos_n"], r["neg_n"], r["weight"]) for r in model.weights.collect()}
    # vocabulary 3, 3 positive and 2 negative tokens: shares over 6 and 5.
    import math

    weigh = lambda p, n: round(math.log(((p + 1) / 6) / ((n + 1) / 5)) * 1e6)
    assert got == {"a": (1, 0, weigh(1, 0)), "b": (2, 1, weigh(2, 1)), "c": (0, 1, weigh(0, 1))}
    docs = spark.createDataFrame([(1, "a b"), (2, "unseen"), (3, ""), (4, None)], "doc_id int, abstract string")
    scores = {r["doc_id"]: r["score"] for r in classify.score_naive_bayes(docs, model, ["doc_id"]).collect()}
    mean = (weigh(1, 0) + weigh(2, 1)) / 2 / 1e6
    assert scores == {1: round(1 / (1 + math.exp(-mean)), 6), 2: 0.5, 3: 0.5, 4: 0.5}
    prior = classify.train_naive_bayes(examples, class_prior=True).prior
    assert prior == pytest.approx(0.0)


def scorer(docs):
    return docs.withColumn("score", F.when(F.col("abstract").contains("good"), 0.9).otherwise(0.1))


def test_stream_filter_takes_new_files_once(spark, tmp_path):
    source, sink, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    schema = "file_no string, row_idx long, pmid string, abstract string"

    def land(file_no, words):
        data = [(file_no, i, f"{file_no}-{i}", f"{w} abstract text") for i, w in enumerate(words)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)

    land("0001", ["good", "bad", "good"])
    counts = []
    for new in (None, ["good"], None):
        if new:
            land("0002", new)
        filter_new_files(spark, source, spark.read.parquet(source).schema, sink, offsets, scorer)
        counts.append(spark.read.parquet(sink).count())
    assert counts == [2, 3, 3]


@pytest.mark.parametrize("max_lines", [-1, 1, 2])
def test_stream_result_equals_one_batch(spark, tmp_path, max_lines):
    """One article file in three part files, with repeated pmids, over two runs."""
    source, sink, offsets = (str(tmp_path / n) for n in ("in dir", "out", "offsets"))
    data = [("0001", i, "aabbcad"[i], f"good abstract text {i}") for i in range(7)]
    everything = spark.createDataFrame(data, "file_no string, row_idx long, pmid string, abstract string")
    for part in ([0, 4], [2, 6], [1, 3, 5]):
        chosen = everything.where(F.col("row_idx").isin(part)).coalesce(1)
        chosen.write.mode("append").parquet(source)
        if part != [0, 4]:
            filter_new_files(spark, source, everything.schema, sink, offsets, scorer)
    batch = filter_articles(everything, scorer, max_lines)
    assert rows(read_filtered(spark, sink, max_lines).select(batch.columns)) == rows(batch)


def test_stream_numbers_foreign_files(spark, tmp_path):
    source, sink, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    for k in range(2):
        data = [(f"{k}{i}", "good abstract text") for i in range(3)]
        spark.createDataFrame(data, "pmid string, abstract string").coalesce(1).write.parquet(f"{source}/year={k}")
    schema = spark.createDataFrame([], "pmid string, abstract string").schema
    filter_new_files(spark, source, schema, sink, offsets, scorer)
    got = read_filtered(spark, sink, 1)
    assert got.count() == 4 and got.select("file_path").distinct().count() == 2


def test_a_second_annotation_tags_new_rows_only(spark, tmp_path, plan):
    spark.createDataFrame([(1, "a"), (2, "b")], "tab_id long, abstract string").write.saveAsTable("tag_twice")
    done = spark.createDataFrame([(1,)], "tab_id long")
    done.write.saveAsTable("tag_twice_ann")
    rows_ = spark.table("tag_twice").join(spark.table("tag_twice_ann").select("tab_id"), "tab_id", "left_anti")
    table = spark.createDataFrame([("b", 1, "DNA")], "term string, n int, label string")
    tagged = tagger.tag(rows_, tagger.Dictionary.of(table), ["tab_id"], ["abstract"])
    assert rows(tagged.select("tab_id", "surface")) == [(2, "b")]
    text = plan(tagged)
    assert text.index("LeftAnti") > text.index("Generate")  # children are printed below their parents


def test_plan_does_not_grow_with_the_longest_term(spark, plan):
    docs = spark.createDataFrame([(1, "w " * 60)], "doc_id long, abstract string")

    def size(n):
        terms = [(" ".join(["w"] * k), k, "DNA") for k in range(1, n + 1)]
        found = tagger.Dictionary.of(spark.createDataFrame(terms, "term string, n int, label string"))
        matches = tagger.matches(docs, found, ["doc_id"], ["abstract"])
        assert matches.count() == sum(60 - k + 1 for k in range(1, n + 1))
        return len(matches._jdf.queryExecution().optimizedPlan().toString())

    assert size(40) < 1.1 * size(2) + 600  # the lengths themselves are listed


def test_stream_parse_takes_names_with_spaces(spark, tmp_path):
    folder = tmp_path / "in dir"
    folder.mkdir()
    (folder / "pub med+23n%0001.xml.gz").write_bytes(gzip.compress(document(citation(5))))
    parse_new_files(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "offsets"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("pmid")) == [("5",)]


def test_stream_parse_rejects_damaged_files(spark, tmp_path):
    folder, sink, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")
    deliver(folder, "0001", [(1, "t", "a")])
    whole = gzip.compress(document(*[citation(50 + i, abstract=("w " * 99,)) for i in range(99)]))
    (folder / "pubmed23n0002.xml.gz").write_bytes(whole[: len(whole) // 2])
    seen = []
    for number in (None, "0003", None):
        if number:
            deliver(folder, number, [(3, "t", "a")])
        parse_new_files(spark, str(folder), sink, offsets)
        seen.append(rows(spark.read.parquet(sink).select("pmid", "file_no")))
    assert seen == [[("1", "0001")], [("1", "0001"), ("3", "0003")], [("1", "0001"), ("3", "0003")]]


def test_stream_lists_withdrawn_articles(spark, tmp_path):
    """Also of files without articles; each file once; none of damaged files."""
    folder, sink, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")
    folder.mkdir()
    gone = lambda *pmids: "<DeleteCitation>" + "".join(f"<PMID Version='1'>{p}</PMID>" for p in pmids) + "</DeleteCitation>"
    put = lambda number, data: (folder / f"pubmed23n{number}.xml.gz").write_bytes(data)
    put("0001", gzip.compress(document(citation(1), gone(8, 9))))
    put("0002", gzip.compress(document(gone(*range(20, 60))))[:-9])
    put("0003", gzip.compress(document(citation(2))))
    seen = []
    for number in (None, "0004", None):
        if number:
            put(number, gzip.compress(document(gone(7))))
        withdraw_new_files(spark, str(folder), sink, offsets)
        found = spark.read.parquet(sink)
        seen.append(rows(found.select("pmid", "delete", "file_no", "abstract")))
    first = [("8", True, "0001", None), ("9", True, "0001", None)]
    assert seen == [first, [("7", True, "0004", None), *first], [("7", True, "0004", None), *first]]
    parse_new_files(spark, str(folder), str(tmp_path / "kept"), str(tmp_path / "other"))
    assert set(found.drop("batch").columns) == set(spark.read.parquet(str(tmp_path / "kept")).drop("batch").columns)


def test_saved_dictionary_loads(spark, tmp_path):
    table = spark.createDataFrame([("a b", 2, "DNA"), ("c", 1, "RNA")], "term string, n int, label string")
    tagger.Dictionary.of(table).save(str(tmp_path / "d"))
    assert tagger.Dictionary.load(spark, str(tmp_path / "d")).lengths == {1: (1, 1), 2: (3, 3)}


def test_model_round_trip(spark, tmp_path):
    data = [(1, "x y", {POSITIVE: 1.0}), (2, "z", {POSITIVE: 0.0})]
    examples = spark.createDataFrame(data, "doc_id int, text string, cats map<string,double>")
    model = classify.train_naive_bayes(examples, class_prior=True)
    model.save(str(tmp_path / "m"))
    back = classify.NaiveBayesModel.load(spark, str(tmp_path / "m"))
    assert back.prior == model.prior and rows(back.weights) == rows(model.weights)
    assert naive_bayes_scorer(back)


@pytest.mark.parametrize("limit", [0, 200, 1000])
def test_scores_do_not_depend_on_model_size(spark, limit):
    """With less room for the broadcast part, rare tokens take the second way."""
    texts = [(i, " ".join(f"w{(i * j) % 37}" for j in range(30)) + " the the", {POSITIVE: float(i % 2)}) for i in range(40)]
    examples = spark.createDataFrame(texts, "doc_id int, text string, cats map<string,double>")
    model = classify.train_naive_bayes(examples)
    docs = spark.createDataFrame(
        [(i, t) for i, t, _ in texts] + [(90, "unseen"), (91, ""), (92, None), (93, "the w1 unseen")], "doc_id int, abstract string"
    )
    whole = rows(classify.score_naive_bayes(docs, model, ["doc_id"]))
    spark.conf.set("spark.citemill.broadcastBytes", str(limit))
    try:
        common, least = classify.common_tokens(model.weights)
        assert least > 0 and common.count() < model.weights.count()
        assert rows(classify.score_naive_bayes(docs, model, ["doc_id"])) == whole
    finally:
        spark.conf.unset("spark.citemill.broadcastBytes")
