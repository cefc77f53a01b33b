"""Precision, recall and F with the seeds that define 0/0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where the false-positive and false-negative counts start.
SEED = 1e-8
# Fixed value: what the span scorer adds to a denominator.
TINY = 1e-100


def precision(tp: Column, fp: Column) -> Column:
    return tp / (tp + fp + F.lit(SEED))


def recall(tp: Column, fn: Column) -> Column:
    return tp / (tp + fn + F.lit(SEED))


def specificity(tn: Column, fp: Column) -> Column:
    return tn / (tn + fp + F.lit(SEED))


def f_score(p: Column, r: Column) -> Column:
    return F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def span_ratio(hits: Column, misses: Column) -> Column:
    return hits / (hits + misses + F.lit(TINY))


def span_f(p: Column, r: Column) -> Column:
    return 2 * (p * r / (p + r + F.lit(TINY)))
