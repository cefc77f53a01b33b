from __future__ import annotations

import contextlib
import gzip
import json
import random
import warnings

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citemill.plans.filter_corpus import filter_articles
from citemill.sources import article_parquet, article_xml, json_list, keyed_json, labelled, tables


def citation(pmid, title="A title", abstract=("Some text.",), extra=""):
    parts = "".join(f"<AbstractText Label='X'>{a}</AbstractText>" for a in abstract)
    body = f"<Abstract>{parts}</Abstract>" if abstract else ""
    return f"""<PubmedArticle><MedlineCitation Status="MEDLINE"><PMID Version="1">{pmid}</PMID>
      <Article><Journal><JournalIssue><Volume>7</Volume><Issue>2</Issue>
      <PubDate><Year>1999</Year></PubDate></JournalIssue><Title>J Test</Title></Journal>
      <ArticleTitle>{title}</ArticleTitle><Pagination><MedlinePgn>1-9</MedlinePgn></Pagination>{body}
      <AuthorList><Author><LastName>Doe</LastName><ForeName>Jo</ForeName>
      <AffiliationInfo><Affiliation>Here</Affiliation></AffiliationInfo></Author>
      <Author><LastName>Roe</LastName></Author></AuthorList></Article>{extra}
      <MeshHeadingList><MeshHeading><DescriptorName UI="D1">Mice</DescriptorName></MeshHeading></MeshHeadingList>
      </MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType="pubmed">{pmid}</ArticleId>
      <ArticleId IdType="doi">10.1/{pmid}</ArticleId><ArticleId IdType="pmc">PMC{pmid}</ArticleId></ArticleIdList>
      <ReferenceList><Reference><Citation>X</Citation><ArticleIdList><ArticleId IdType="pubmed">77</ArticleId>
      </ArticleIdList></Reference><Reference><Citation>Y</Citation></Reference></ReferenceList>
      </PubmedData></PubmedArticle>"""


def document(*citations):
    return ('<?xml version="1.0"?>\n<PubmedArticleSet>' + "\n".join(citations) + "</PubmedArticleSet>").encode()


@pytest.fixture
def xml_dir(tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    good = document(
        citation(1, "On <i>E. coli</i> p &lt; 0.05 and x &gt; 3", ("One <sup>18</sup>F.", "Two &amp; three."), "<OtherID Source='S'>N1</OtherID>"),
        citation(2, abstract=()),
    )
    (folder / "pubmed23n0001.xml.gz").write_bytes(gzip.compress(good))
    many = document(*[citation(100 + i, abstract=("word " * 40,)) for i in range(200)])
    packed = gzip.compress(many)
    (folder / "pubmed23n0002.xml.gz").write_bytes(packed[: len(packed) // 2])
    (folder / "pubmed23n0003.xml.gz").write_bytes(b"this is not gzip")
    cut = document(citation(301), citation(302))
    (folder / "pubmed23n0004.xml.gz").write_bytes(gzip.compress(cut[: len(cut) - 300]))
    (folder / "pubmed23n0005.xml").write_bytes(document(citation(501)))
    two = gzip.compress(document(citation(601))[:400]) + gzip.compress(document(citation(601))[400:])
    (folder / "pubmed23n0006.xml.gz").write_bytes(two)
    return str(folder)


def test_reads_intact_files_only(spark, xml_dir):
    got = {r["pmid"]: r for r in article_xml.read_articles(spark, xml_dir).collect()}
    assert set(got) == {"1", "2", "501", "601"}
    first = got["1"]
    assert first["title"] == "On E. coli p < 0.05 and x > 3"
    assert first["abstract"] == "One 18F.\nTwo & three."
    assert (first["journal"], first["issue"], first["pages"], first["pubdate"]) == ("J Test", "7(2)", "1-9", "1999")
    assert (first["authors"], first["mesh_terms"], first["doi"]) == ("Doe Jo; Roe", "Mice", "10.1/1")
    assert (first["references"], first["affiliations"], first["pmc"], first["other_id"]) == ("77", "Here", "PMC1", "N1")
    assert (first["file_no"], first["file_name"]) == ("0001", "pubmed23n0001.xml.gz")
    assert got["2"]["abstract"] is None and got["501"]["file_no"] == "0005"
    assert first["row_idx"] < got["2"]["row_idx"]


def test_manifest(spark, xml_dir):
    checked = article_xml.check_files(article_xml.list_files(spark, xml_dir)).collect()
    assert {r["file_path"][-11:-7] if r["file_path"].endswith("gz") else "0005": r["ok"] for r in checked} == {
        "0001": True, "0002": False, "0003": False, "0004": False, "0005": True, "0006": True,
    }


def test_deleted_citations(spark, tmp_path):
    data = document(citation(1), "<DeleteCitation><PMID Version='1'>8</PMID><PMID Version='1'>9</PMID></DeleteCitation>")
    (tmp_path / "pubmed23n0001.xml.gz").write_bytes(gzip.compress(data))
    got = article_xml.read_articles(spark, str(tmp_path), include_deleted=True)
    assert rows(got.select("pmid", "delete", "abstract")) == [
        ("1", False, "Some text."), ("8", True, None), ("9", True, None)
    ]


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        article_xml.read_articles(spark, str(tmp_path / "nowhere"))


def test_numbers_rows_of_foreign_parquet(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "p"))
    got = article_parquet.read_article_parquet(spark, str(tmp_path / "p"))
    assert sorted(r["row_idx"] for r in got.collect()) == [0, 1, 2, 3, 4]


def test_runs_count_once_finished(spark, tmp_path):
    out = str(tmp_path / "out")
    kept = spark.createDataFrame([("1", "a")], "file_no string, pmid string")
    files = spark.createDataFrame([("1",), ("2",)], "file_no string")
    assert article_parquet.finished_files(spark, out).count() == 0
    article_parquet.append_run(kept, files, out)
    kept.write.parquet(f"{out}/kept/run=died")
    assert rows(article_parquet.read_kept(spark, out)) == [("1", "a")]
    done = article_parquet.finished_files(spark, out)
    new = spark.createDataFrame([("1",), ("2",), ("3",)], "file_no string")
    assert rows(article_parquet.remaining(new, done, ["file_no"])) == [("3",)]


ARTICLE = T.StructType([T.StructField(c, T.StringType()) for c in ("pmid", "title", "abstract")])


def test_keyed_json_one_object_per_file(spark, tmp_path):
    body = {"7": {"title": "t", "abstract": "a\n\"b\"", "pmid": "7", "class_value": 0.75},
            "8": {"title": None, "abstract": "c", "pmid": "8", "class_value": 0.5}}
    (tmp_path / "0012.json").write_text(json.dumps(body), encoding="utf8")
    (tmp_path / "0013.json").write_text("{}", encoding="utf8")
    got = keyed_json.read_keyed_json(spark, str(tmp_path), ARTICLE)
    assert rows(got.select("file_no", "pmid", "title", "abstract", "class_value")) == [
        ("0012", "7", "t", 'a\n"b"', 0.75), ("0012", "8", None, "c", 0.5)
    ]


CATS = [["one text", {"cats": {"POSITIVE_NUCL_MED": True, "NEGATIVE_NUCL_MED": False}}],
        ["two \"q\"\n", {"cats": {"POSITIVE_NUCL_MED": 0.25, "NEGATIVE_NUCL_MED": 1}}]]
SPANS = [["uses [radiotracer] here", {"entities": [[5, 18, "RADIOTRACER_S"]]}],
         ["two [a b] and [c]", {"entities": [[4, 9, "RADIOTRACER_L"], [14, 17, "RADIOTRACER_S"]]}],
         ["none", {"entities": []}]]


@pytest.mark.parametrize("layout", ["first line", "lines"])
def test_labelled_examples(spark, tmp_path, layout):
    def write(name, data):
        lines = [json.dumps(data), json.dumps([["ignored", {}]])] if layout == "first line" else map(json.dumps, data)
        (tmp_path / name).write_text("\n".join(lines))
        return str(tmp_path / name)

    cats = {r["text"]: r["cats"] for r in labelled.read_cats(spark, write("cats.json", CATS)).collect()}
    assert cats == {
        "one text": {"POSITIVE_NUCL_MED": 1.0, "NEGATIVE_NUCL_MED": 0.0},
        "two \"q\"\n": {"POSITIVE_NUCL_MED": 0.25, "NEGATIVE_NUCL_MED": 1.0},
    }
    spans = labelled.entity_rows(labelled.read_entities(spark, write("spans.json", SPANS)), [])
    assert rows(spans) == [
        (14, 17, "RADIOTRACER_S", "[c]"), (4, 9, "RADIOTRACER_L", "[a b]"), (5, 18, "RADIOTRACER_S", "[radiotracer]"),
    ]


def kept(spark, pmids, file_no="0001"):
    data = [(file_no, i, p, 0.75) for i, p in enumerate(pmids)]
    return spark.createDataFrame(data, "file_no string, row_idx long, pmid string, class_value double")


SCHEMA = "tab_id long, pmid string, class_value string, clean_abstract string, clean_title string, more string"


@pytest.mark.parametrize("buckets", [0, 3])
def test_table_load(spark, tmp_path, buckets):
    name = f"load_{buckets}"
    assert not tables.fill_table(kept(spark, "a"), "no_such_table")
    schema = T._parse_datatype_string(SCHEMA)
    assert tables.create_table(spark, name, schema, str(tmp_path / name), buckets)
    with pytest.warns(UserWarning):
        assert not tables.create_table(spark, name, schema)
    assert name in tables.table_names(spark)
    tables.fill_table(kept(spark, "bca", "0002").unionByName(kept(spark, "xx")), name)
    tables.fill_table(kept(spark, "z"), name)
    got = spark.table(name).orderBy("tab_id").collect()
    assert [(r["tab_id"], r["pmid"]) for r in got] == [(1, "x"), (2, "x"), (3, "b"), (4, "c"), (5, "a"), (6, "z")]
    assert got[0]["class_value"] == "0.75" and got[0]["clean_title"] == "" and got[0]["more"] is None


def test_distinct_pmids(spark, tmp_path):
    tables.create_table(spark, "distinct_load", T._parse_datatype_string(SCHEMA), str(tmp_path / "d"))
    tables.fill_table(kept(spark, "aab"), "distinct_load", distinct_pmids=True)
    assert rows(spark.table("distinct_load").select("tab_id", "pmid")) == [(1, "a"), (2, "b")]


def test_insert_ignore_runs_twice(spark, tmp_path):
    schema = T._parse_datatype_string("tab_id long, v string")
    tables.create_table(spark, "ignore_load", schema, str(tmp_path / "i"), 2)
    old = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    new = spark.createDataFrame([(2, "other"), (3, "c")], schema)
    for part in (old, new, new, spark.table("ignore_load")):
        tables.insert_ignore(part, "ignore_load")
    assert rows(spark.table("ignore_load")) == [(1, "a"), (2, "b"), (3, "c")]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert not tables.insert_ignore(new, "no_such_table")


def test_sub_folders_and_names_with_spaces(spark, tmp_path):
    folder = tmp_path / "root" / "ftp site" / "base line"
    folder.mkdir(parents=True)
    (folder / "a b%20+c.xml.gz").write_bytes(gzip.compress(document(citation(1))))
    (tmp_path / "root" / "plain.xml").write_bytes(document(citation(2)))
    cut = document(citation(3), citation(4))
    (folder / "cut.xml").write_bytes(cut[:-200])
    (folder / "unclosed.xml").write_bytes(cut[: -len("</PubmedArticleSet>")])
    got = article_xml.read_articles(spark, str(tmp_path / "root")).collect()
    assert sorted(r["pmid"] for r in got) == ["1", "2"]


def test_equal_names_in_two_folders(spark, tmp_path):
    for year in (2022, 2023):
        data = [(f"{year}-{i}", "x" * 20) for i in range(4)]
        part = spark.createDataFrame(data, "pmid string, abstract string").coalesce(1)
        part.write.parquet(str(tmp_path / f"year={year}"))
        for file in (tmp_path / f"year={year}").glob("part-*"):
            file.rename(tmp_path / f"year={year}" / "0001.parquet")
        for file in (tmp_path / f"year={year}").glob(".part-*"):
            file.unlink()
    articles = article_parquet.read_article_parquet(spark, str(tmp_path))
    assert articles.select("file_path", "row_idx").distinct().count() == 8
    assert [r[0] for r in articles.select("file_no").distinct().collect()] == ["0001"]
    score = F.when(F.col("pmid").endswith("3"), 0.1).when(F.col("pmid").startswith("2022"), 0.8).otherwise(0.9)
    kept = filter_articles(articles, lambda docs: docs.withColumn("score", score))
    expected = [(f"{y}-{i}", s) for y, s in ((2022, 0.8), (2023, 0.9)) for i in range(3)]
    assert rows(kept.select("pmid", "class_value")) == expected


def test_keyed_json_is_loaded(spark, tmp_path):
    body = {"7": {"title": "t", "abstract": "a"}, "8": {"title": "u", "abstract": "b"}}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0001.json").write_text(json.dumps(body, indent=1))
    got = keyed_json.read_keyed_json(spark, str(tmp_path / "in"), ARTICLE, whole_files=True)
    tables.create_table(spark, "keyed_load", T._parse_datatype_string("tab_id long, pmid string, title string"), str(tmp_path / "t"))
    tables.fill_table(got, "keyed_load")
    assert rows(spark.table("keyed_load")) == [(1, "7", "t"), (2, "8", "u")]
    with pytest.raises(Exception, match="unreadable JSON"):
        keyed_json.read_keyed_json(spark, str(tmp_path / "in"), ARTICLE).collect()


@contextlib.contextmanager
def bytes_per_task(spark, size):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, str(size))
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def test_labelled_layouts_and_broken_lines(spark, tmp_path):
    (tmp_path / "spaced.json").write_text(" [ " + json.dumps(CATS)[1:])
    assert labelled.read_cats(spark, str(tmp_path / "spaced.json")).count() == 2
    (tmp_path / "bracket.json").write_text(json.dumps(["[a] b", CATS[0][1]]) + "\n\n")
    assert [r["text"] for r in labelled.read_cats(spark, str(tmp_path / "bracket.json")).collect()] == ["[a] b"]
    (tmp_path / "broken.json").write_text("\n".join([json.dumps(CATS[0]), json.dumps(CATS[1])[:-5]]))
    with pytest.raises(Exception, match="unreadable JSON"):
        labelled.read_cats(spark, str(tmp_path / "broken.json")).collect()


def test_one_row_per_key_of_a_load(spark, tmp_path):
    schema = T._parse_datatype_string("tab_id long, v string, w string")
    tables.create_table(spark, "twice_load", schema, str(tmp_path / "w"))
    tables.insert_ignore(spark.createDataFrame([(1, "b", None), (1, "a", "x"), (2, "c", "y")], schema), "twice_load")
    assert rows(spark.table("twice_load")) == [(1, "a", "x"), (2, "c", "y")]


def test_labelled_files_of_both_layouts_in_a_folder(spark, tmp_path):
    pair = lambda i: [f"text {i}", {"cats": {"POSITIVE_NUCL_MED": i % 2 == 0}}]
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([pair(1), pair(2)]) + "\n" + json.dumps([["later", {}]]))
    (folder / "b.json").write_text("\n" + json.dumps([pair(3)]))
    (folder / "c.json").write_text("\n".join(json.dumps(pair(i)) for i in (4, 5)))
    (folder / "d.json").write_text("[]\n")
    got = {r["text"]: r["cats"]["POSITIVE_NUCL_MED"] for r in labelled.read_cats(spark, str(folder)).collect()}
    assert got == {f"text {i}": float(i % 2 == 0) for i in range(1, 6)}


def test_a_list_is_read_by_many_tasks(spark, tmp_path):
    draw = random.Random(3)
    odd = ["]", "[", '"', "\\", "\\\\", '\\"', "], [", "é", "\n", "{", "}", ",", "word ", '"]]', "\U0001f600"]
    text = lambda: "".join(draw.choice(odd) for _ in range(draw.randrange(12)))
    pair = lambda: [text(), {"entities": [[draw.randrange(9), draw.randrange(9), text()] for _ in range(draw.randrange(4))]}]
    pairs = [pair() for _ in range(300)]
    folder = tmp_path / "lists [1]+ %41"
    folder.mkdir()
    (folder / "a {x}*.json").write_text(json.dumps(pairs[:120]))
    (folder / "b.json").write_text(json.dumps(pairs[120:200], indent=2, ensure_ascii=False) + '\n[["later", {"x"')
    (folder / "c.json").write_text("\n".join(json.dumps(p) for p in pairs[200:]))
    with bytes_per_task(spark, 64):
        escaped = str(folder).replace("[", "\\[").replace("]", "\\]")
        assert json_list.read_pieces(spark, escaped).rdd.getNumPartitions() > 50
        got = labelled.read_entities(spark, escaped).collect()
    plain = lambda rows: sorted((t, [tuple(e) for e in es]) for t, es in rows)
    assert plain((r["text"], [(e["start"], e["end"], e["label"]) for e in r["entities"]]) for r in got) == plain(
        (t, b["entities"]) for t, b in pairs
    )


@pytest.mark.parametrize("damage", ['[["a", {"cats": {}}]', '[["a", {"cats": {}}], 5]', '[["a", {"cats": {}}], ["b", {', '[["a", {"cats": {}}] ["b", {}]]'])
def test_a_damaged_list_fails(spark, tmp_path, damage):
    (tmp_path / "x.json").write_text(damage)
    with pytest.raises(Exception, match="unreadable JSON"):
        labelled.read_cats(spark, str(tmp_path / "x.json")).collect()


def test_one_json_object_per_input_file(spark, tmp_path):
    docs = spark.createDataFrame(
        [(f"d/{'ab'[i % 2]}.parquet", "0007" if i % 3 else "00 8", i, str(i), f'a "b"\n{{{i}}},', None if i % 5 else f"é{i}")
         for i in range(200)],
        "file_path string, file_no string, row_idx long, pmid string, title string, abstract string",
    )
    files = docs.select("file_path", "file_no").unionByName(spark.createDataFrame([("d/c.parquet", "0009")], "file_path string, file_no string"))
    out = str(tmp_path / "objects")
    keyed_json.write_keyed_files(docs, out, files)
    written = sorted((tmp_path / "objects").rglob("*.txt"))
    objects = [json.loads(f.read_text(encoding="utf8")) for f in written]
    assert len(written) == 5 and sorted(map(len, objects)) == [0, 33, 34, 66, 67]
    for found in objects:
        assert list(found) == sorted(found, key=int)  # in row order
        assert all(v["title"] == f'a "b"\n{{{k}}},' and v.get("abstract") == (None if int(k) % 5 else f"é{k}") for k, v in found.items())
    want = rows(docs.select("file_no", "pmid", "title", "abstract"))
    for how in ({"entries": True}, {"whole_files": True}):
        back = keyed_json.read_keyed_json(spark, out, docs.schema, **how)
        assert rows(back.select("file_no", "pmid", "title", "abstract")) == want
    # Without paths files go by their number; an empty table gives no file.
    keyed_json.write_keyed_files(docs.drop("file_path"), str(tmp_path / "plain"))
    assert len(list((tmp_path / "plain").rglob("*.txt"))) == 2
    keyed_json.write_keyed_files(docs.limit(0), str(tmp_path / "none"))
    assert not list((tmp_path / "none").rglob("*.txt"))


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    text = F.sha2(F.col("id").cast("string"), 512)
    many = spark.range(0, 80_000, 1, 8).select(F.col("id").alias("tab_id"), text.alias("v"))
    tables.create_table(spark, "large_buckets", many.schema, str(tmp_path / "t"), 2)
    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(size) for size in sizes]
    for size in sizes:
        spark.conf.set(size, "100k")
    try:
        tables.insert_ignore(many, "large_buckets")
    finally:
        for size, value in zip(sizes, before):
            spark.conf.set(size, value)
    assert len(list((tmp_path / "t").glob("part-*"))) > 2
    assert rows(spark.table("large_buckets")) == rows(many)
    assert spark.table("large_buckets").groupBy("tab_id").count().where("count > 1").isEmpty()


def test_many_examples_make_more_lists_not_longer_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(labelled, "LIST_BYTES", 2000)
    df = spark.range(300).select(F.concat(F.lit("text "), "id").alias("text"), F.create_map(F.lit("A"), F.lit(1.0)).alias("cats"))
    labelled.write_cats_lists(df, str(tmp_path / "lists"), 2)
    written = [f for f in (tmp_path / "lists").rglob("*.txt")]
    assert len(written) > 2 and max(f.stat().st_size for f in written) < 4000
    assert rows(labelled.read_cats(spark, str(tmp_path / "lists")).select("text")) == rows(df.select("text"))
