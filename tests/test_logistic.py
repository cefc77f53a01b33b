"""Logistic regression: the same coefficients for any partitions, against a dense Newton solver."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from citemill import corpus
from citemill.operators import classify, evaluate, logistic
from citemill.schemas import POSITIVE
from citemill.shared import ARROW_ROWS

FEATURES = 64


def examples(spark, n=120):
    draw = random.Random(3)
    rows = []
    for i in range(n):
        positive = draw.random() < 0.5
        words = draw.choices(["scan", "fdg", "dose"] if positive else ["rock", "jazz", "tune"], k=draw.randint(0, 8))
        words += draw.choices(["the", "a", "of", "scan", "rock"], k=draw.randint(0, 6))
        rows.append((i, " ".join(words), {POSITIVE: float(positive)} if i % 17 else {}))
    rows.append((n, None, {POSITIVE: 1.0}))
    return rows, spark.createDataFrame(rows, "doc_id int, text string, cats map<string,double>")


def dense(rows):
    """tf-idf rows of unit length and labels, by plain Python."""
    counts, labels = [], []
    for _, text, cats in rows:
        if POSITIVE in cats:
            own = np.zeros(FEATURES)
            for word in (text or "").split():
                signed = np.uint64(xxhash.xxh64_intdigest(word, seed=42)).astype(np.int64)
                own[int(signed) % FEATURES] += 1
            counts.append(own)
            labels.append(cats[POSITIVE])
    counts = np.array(counts)
    x = counts * np.log((len(counts) + 1) / ((counts > 0).sum(axis=0) + 1))
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1), np.array(labels)


def newton(x, y, reg):
    """The optimum by iterated weighted least squares."""
    x = np.hstack((x, np.ones((len(x), 1))))
    penalty = np.diag([reg] * (x.shape[1] - 1) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - y) / len(x) + penalty @ w
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x / len(x) + penalty + 1e-12 * np.eye(len(w)), gradient)
    return w


def test_fit_reaches_the_optimum(spark):
    rows, df = examples(spark)
    path = logistic.fit(df, FEATURES, max_iter=60, reg=0.01)
    x, y = dense(rows)
    w = newton(x, y, 0.01)
    margin = x @ w[:-1] + w[-1]
    best = np.mean(np.logaddexp(0, margin) - y * margin) + 0.005 * (w[:-1] ** 2).sum()
    assert path[0].loss == pytest.approx(math.log(2))
    assert all(a.loss >= b.loss for a, b in zip(path, path[1:]))
    assert path[-1].loss == pytest.approx(best, abs=1e-6)
    assert np.abs(path[-1].model.coefficients - w[:-1]).max() < 1e-2
    got = [r["score"] for r in classify.score_logistic(df, path[-1].model, "text").orderBy("doc_id").collect()]
    own = iter(1 / (1 + np.exp(-margin)))
    assert all(abs(s - next(own)) < 1e-2 for s, (_, _, cats) in zip(got, rows) if POSITIVE in cats)


def test_coefficients_do_not_depend_on_partitions(spark):
    df = corpus.examples(spark, "/root/testdata/sf0.001")
    models = [logistic.fit(df.repartition(n), 1 << 12, max_iter=3)[-1].model for n in (1, 4, 37)]
    for other in models[1:]:
        assert np.array_equal(models[0].coefficients, other.coefficients) and models[0].intercept == other.intercept


def test_history_is_that_of_separate_fits(spark):
    _, df = examples(spark)
    train, test = df.where("doc_id % 5 <> 0"), df.where("doc_id % 5 = 0")
    history = {(r["iteration"], r["metric"]): r["value"] for r in evaluate.metric_history(train, test, [1, 4], FEATURES).collect()}
    assert sorted(i for i, m in history if m == "losses") == [0, 1, 2, 3, 4]
    for checkpoint in (1, 4):
        model = classify.train_logistic(train, FEATURES, checkpoint)
        rates = evaluate.confusion(classify.score_logistic(test, model, "text")).first()
        for metric, column in (("precision", "p"), ("recall", "r"), ("fscore", "f"), ("specificity", "s")):
            assert history[checkpoint, metric] == rates[f"textcat_{column}"]


def test_saved_model_scores_alike(spark, tmp_path):
    _, df = examples(spark, 40)
    model = classify.train_logistic(df, FEATURES, 3)
    model.save(spark, str(tmp_path / "m"))
    again = logistic.LogisticModel.load(spark, str(tmp_path / "m"))
    scores = lambda m: [r["score"] for r in classify.score_logistic(df, m, "text").orderBy("doc_id").collect()]
    assert scores(model) == scores(again)


def test_no_labelled_examples(spark):
    _, df = examples(spark, 10)
    with pytest.raises(ValueError):
        logistic.fit(df.where("false"), FEATURES)


def test_batches_are_worked_on_in_pieces(spark, monkeypatch):
    """What is held at once follows the tokens of a piece, not the rows of a batch."""
    monkeypatch.setattr(logistic, "PIECE_TOKENS", 10)
    lists = pa.array([[1] * 4, None, [2] * 5, [3] * 30, [], [4] * 9, [5]], type=pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array([1.0] * 7), lists], names=["label", "terms"])
    cut = list(logistic.in_pieces(iter([batch])))
    assert pa.Table.from_batches(cut).to_pylist() == batch.to_pylist()
    sizes = [len(pa.compute.list_flatten(b.column(1))) for b in cut]
    assert all(size <= 10 or b.num_rows == 1 for size, b in zip(sizes, cut)) and len(cut) == 3
    _, df = examples(spark)
    spark.conf.unset(ARROW_ROWS)
    logistic.Objective(logistic.training_rows(df, FEATURES), FEATURES, 0.01)
    assert int(spark.conf.get(ARROW_ROWS)) <= 1000
