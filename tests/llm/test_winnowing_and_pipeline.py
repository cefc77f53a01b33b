from __future__ import annotations

import hashlib
import re

from llm.conftest import ODD, PROSE, frame, got, texts_of

import corpus_pipeline
from citemill.llm import winnowing
from citemill.llm.oracle import ORACLE_SQL
from citemill.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SF = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for ident, text in texts:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    found |= own
                    hit |= set(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((ident, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEMS = [(1, PROSE), (2, "Short one!"), (10, "word"), (3, None), (4, "... --"), (5, PROSE + " more"), (5, "lost in the woods again")]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, 1, "k") for i, t in items], "item_id long, text string, hash int, key string")


def test_odd_rows_and_short_items(spark, odd):
    texts = [*ODD, (20, "x y " + PROSE[:120]), (21, "a SHORT, one; word é"), (22, " ".join(f"u{i}" for i in range(300)) + " " + PROSE)]
    assert got(winnowing.digest(frame(spark, texts), benchmark(spark))) == brute(texts, ITEMS)


def test_real_documents(spark, sample):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = brute(texts_of(sample), [(r["item_id"], r["text"]) for r in items.collect()])
    assert any(r[5] for r in expected)
    assert got(winnowing.digest(sample, items)) == expected


def test_empty_tables(spark, odd, nothing):
    assert winnowing.digest(nothing, benchmark(spark)).count() == 0
    assert got(winnowing.digest(odd, benchmark(spark, []))) == brute(ODD, [])
    assert got(winnowing.digest(odd, benchmark(spark, [(1, None)]))) == brute(ODD, [])


def test_decontaminate_drops_just_the_contaminated(spark, odd):
    out = winnowing.decontaminate(odd, benchmark(spark))
    assert out.columns == odd.columns
    clean = [t for t, r in zip(ODD, [brute([t], ITEMS)[0] for t in ODD]) if not r[5]]
    assert got(out, "doc_id", "text") == sorted(clean, key=str)


def test_nothing_changes_without_broadcasts(spark, sample):
    """Sides too large to be broadcast are shuffled."""
    from llm import test_ngram_rtree, test_repeats

    from citemill.llm import gear_chunks, ngram_rtree, style_tree, suffix_groups

    texts = test_ngram_rtree.families(11, 5, 16, (30, 90), 6)
    docs, pages = frame(spark, texts), spark.read.parquet(f"{SF}/pages.parquet")
    pasted = test_repeats.pasted(12, 20)
    before = got(gear_chunks.report(docs)), got(style_tree.extract(pages))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert got(ngram_rtree.digest(docs)) == test_ngram_rtree.brute(texts)
        assert got(suffix_groups.digest(frame(spark, pasted))) == test_repeats.brute(pasted)
        assert got(winnowing.digest(frame(spark, ODD), benchmark(spark))) == brute(ODD, ITEMS)
        assert (got(gear_chunks.report(docs)), got(style_tree.extract(pages))) == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_on_the_main_path(spark, sample):
    plan = winnowing.digest(sample, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


def test_pipeline_stages(spark, sample):
    """Each stage against brute force over what the stage before kept."""
    from llm import test_ngram_rtree, test_packing, test_pii, test_quality_bands

    docs = sample
    texts = texts_of(docs)
    kept = [(i, t) for i, t in texts if test_quality_bands.brute(t)[-1]]
    docs = corpus_pipeline.quality_rules(spark, docs, SF)
    assert got(docs, "doc_id", "text") == sorted(kept, key=str)

    first = {c for _, _, c in test_ngram_rtree.brute(kept, n=5, percent=80)}
    kept = [(i, t) for i, t in kept if i in first]
    docs = corpus_pipeline.ngram_jaccard_join(spark, docs, SF)
    assert got(docs, "doc_id", "text") == sorted(kept, key=str)

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute(kept, items) if not r[5]}
    kept = [(i, t) for i, t in kept if i in clean]
    docs = corpus_pipeline.benchmark_decontamination(spark, docs, SF)
    assert got(docs, "doc_id", "text") == sorted(kept, key=str)

    docs = corpus_pipeline.personal_data(spark, docs, SF)
    assert docs.columns == sample.columns
    masked = texts_of(docs)
    assert {i for i, _ in masked} == clean
    assert not any(n for _, t in masked for n in test_pii.brute(t)[:4])

    from tokenizers import Tokenizer

    rows = corpus_pipeline.sequence_packing(spark, docs, SF).collect()
    test_packing.check(Tokenizer.from_file(test_packing.PATH), masked, rows)
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == clean


def test_pipeline_takes_odd_documents(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns
            docs = out
        docs.collect()


def test_every_sql_belongs_to_a_query():
    # tests/test_queries.py runs all registered queries against their SQL.
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
