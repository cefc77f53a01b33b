from __future__ import annotations

import random

import pytest

from citemill.operators import evaluate
from citemill.schemas import NEGATIVE, POSITIVE

SCHEMA = "doc_id long, score double, cats map<string,double>"


def sample(n=300, ties=False, seed=3):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        score = rnd.choice([0.0, 0.25, 0.5, 0.75, 1.0]) if ties else rnd.random()
        gold = float(rnd.random() < 0.3 + 0.4 * score)
        data.append((i, score, {POSITIVE: gold, NEGATIVE: 1.0 - gold}))
    return data


def rates(data, thr):
    tp, fp, fn, tn = 0.0, 1e-8, 1e-8, 0.0
    for _, score, cats in data:
        if POSITIVE not in cats:
            continue
        good = cats[POSITIVE] >= 0.5
        if score >= thr:
            tp, fp = tp + good, fp + (not good)
        else:
            fn, tn = fn + good, tn + (not good)
    p, r, s = tp / (tp + fp), tp / (tp + fn), tn / (tn + fp)
    return p, r, (2 * p * r / (p + r) if p + r else 0.0), s


def areas(data, tie):
    pos = [s for _, s, c in data if c.get(POSITIVE) == 1.0 and c.get(NEGATIVE) == 0.0]
    neg = [s for _, s, c in data if c.get(POSITIVE) == 0.0 and c.get(NEGATIVE) == 1.0]
    won = sum((p > n) + tie * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@pytest.mark.parametrize("thr", [0.0, 0.5, 0.75, 1.0])
def test_confusion(spark, thr):
    data = sample(ties=True) + [(999, 0.9, {NEGATIVE: 1.0}), (1000, 0.9, {})]
    got = evaluate.confusion(spark.createDataFrame(data, SCHEMA), thr).first()
    assert [got[f"textcat_{k}"] for k in "prfs"] == pytest.approx(list(rates(data, thr)), abs=1e-12)


def test_confusion_without_positives(spark):
    data = [(1, 0.2, {POSITIVE: 0.0, NEGATIVE: 1.0})]
    got = evaluate.confusion(spark.createDataFrame(data, SCHEMA)).first()
    assert (got["textcat_p"], got["textcat_r"], got["textcat_f"]) == (0.0, 0.0, 0.0)
    assert got["textcat_s"] == pytest.approx(1.0)


@pytest.mark.parametrize("delta", [0.01, 0.03, 0.1, 0.5])
def test_roc_curve_equals_threshold_sweep(spark, delta):
    steps = int(1 / delta)
    edges = [(1000 + i, i / steps, {POSITIVE: float(i % 2), NEGATIVE: 1.0 - i % 2}) for i in range(steps + 1)]
    data = sample() + edges
    curve = evaluate.roc_curve(spark.createDataFrame(data, SCHEMA), delta)
    points = curve.orderBy("point").collect()
    expected = [rates(data, i / steps) for i in reversed(range(steps + 1))]
    assert [p["tpr"] for p in points] == pytest.approx([e[1] for e in expected], abs=1e-12)
    assert [p["fpr"] for p in points] == pytest.approx([1 - e[3] for e in expected], abs=1e-12)
    area = sum(
        (b["fpr"] - a["fpr"]) * (b["tpr"] + a["tpr"]) / 2 for a, b in zip(points, points[1:])
    )
    assert evaluate.trapezoid_auc(curve).first()["auc"] == pytest.approx(area, abs=1e-12)


@pytest.mark.parametrize("ties", [True, False])
@pytest.mark.parametrize("tie", [1.0, 0.5])
def test_areas_equal_pairs(spark, ties, tie):
    data = sample(ties=ties) + [(900, 0.5, {POSITIVE: 1.0, NEGATIVE: 1.0}), (901, 0.5, {POSITIVE: 0.3})]
    got = evaluate.rank_auc(spark.createDataFrame(data, SCHEMA), tie).first()["auc"]
    assert got == pytest.approx(areas(data, tie), abs=1e-12)


def test_areas_over_many_buckets(spark, monkeypatch):
    """Scores crowded into a narrow range, one window task per seven of them."""
    monkeypatch.setattr(evaluate, "BUCKET_SCORES", 7)
    data = [(i, 1 - s * 1e-9 if i % 3 else s, c) for i, s, c in sample(200)]
    got = evaluate.rank_auc(spark.createDataFrame(data, SCHEMA), 0.5).first()["auc"]
    assert got == pytest.approx(areas(data, 0.5), abs=1e-12)


def test_one_equal_pair(spark):
    data = [(1, 0.4, {POSITIVE: 0.0, NEGATIVE: 1.0}), (2, 0.4, {POSITIVE: 1.0, NEGATIVE: 0.0})]
    df = spark.createDataFrame(data, SCHEMA)
    assert evaluate.rank_auc(df, 0.5).first()["auc"] == 0.5
    assert evaluate.pair_auc(df).first()["auc"] == 1.0


def test_area_of_one_class_is_null(spark):
    data = [(1, 0.4, {POSITIVE: 1.0, NEGATIVE: 0.0})]
    assert evaluate.rank_auc(spark.createDataFrame(data, SCHEMA), 0.5).first()["auc"] is None


@pytest.mark.parametrize("bucket", [3, 1000])
def test_rank_puts_later_rows_first_among_ties(spark, monkeypatch, bucket):
    monkeypatch.setattr(evaluate, "BUCKET_SCORES", bucket)
    monkeypatch.setattr("citemill.operators.numbering.BLOCK_ROWS", 4)
    data = [(i, s) for i, s, _ in sample(60, ties=True)]
    ranked = evaluate.rank_by_score(spark.createDataFrame(data, "doc_id long, score double"))
    got = [r["doc_id"] for r in ranked.orderBy("rank").collect()]
    assert got == [i for i, _ in sorted(data, key=lambda r: r[1])][::-1]
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 61))


@pytest.mark.parametrize("bucket", [1, 1_000_000])
def test_samples_without_a_score_count_nowhere(spark, monkeypatch, bucket):
    """The same rule in every metric and on both sides of the bucket limit."""
    monkeypatch.setattr(evaluate, "BUCKET_SCORES", bucket)
    data = sample(40, ties=True)
    missing = [(900 + i, [None, float("nan")][i % 2], data[i][2]) for i in range(9)]
    schema = "doc_id int, score double, cats map<string,double>"
    clean, mixed = spark.createDataFrame(data, schema), spark.createDataFrame(data + missing, schema)
    for metric in (
        evaluate.confusion, evaluate.roc_curve, evaluate.pair_auc, evaluate.positives_above,
        lambda d: evaluate.rank_auc(d, 0.5), lambda d: evaluate.trapezoid_auc(evaluate.roc_curve(d)),
    ):
        assert sorted(map(str, metric(mixed).collect())) == sorted(map(str, metric(clean).collect()))


def test_rank_takes_any_key(spark):
    """Text keys, sparse keys, one score for most rows, and rows without a score."""
    data = [(f"k{i * 7919 % 1000:x}", 0.5 if i % 3 else float(i % 5)) for i in range(400)]
    data += [("zz", None), ("zy", float("nan"))]
    got = evaluate.rank_by_score(spark.createDataFrame(data, "pmid string, score double"), "pmid").collect()
    scored = sorted(data[:-2], key=lambda r: (r[1], r[0]), reverse=True)
    expected = [k for k, _ in scored] + ["zz", "zy"]
    assert [r["pmid"] for r in sorted(got, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in got) == list(range(1, 403))
    hashed = [((i * 0x9E3779B97F4A7C15) % (1 << 63), 0.25) for i in range(300)]
    got = evaluate.rank_by_score(spark.createDataFrame(hashed, "doc_id long, score double")).collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"])] == sorted((k for k, _ in hashed), reverse=True)
