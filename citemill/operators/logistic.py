"""Logistic regression on hashed terms: the same coefficients however the rows are dealt out.

A row is its tf-idf vector of unit length over ``features`` hashed terms. The
optimiser (L-BFGS) lives on the driver and holds vectors of that size, whatever
the vocabulary; each evaluation is one distributed pass that sums loss and
gradient. Every row's share is rounded to whole units first, so the sums, and
with them every step, do not depend on partitions, their order or recomputed
tasks. The coefficients of every iteration are kept: one fit gives the history.

A null text has no terms; rows without a label are left out.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citemill.functions.text import tokens
from citemill.schemas import POSITIVE
from citemill.shared import give_back, materialise, small_batches

FEATURES = 1 << 18
# A row's share of loss and gradient is counted in units of 2**-UNIT_BITS.
UNIT_BITS = 24
UNIT = float(1 << UNIT_BITS)
# Keys of the summed values that belong to no feature.
BIAS, LOSS, ROWS = -1, -2, -3
MEMORY = 10
# Tokens worked on in one go; a row with more is a piece of its own.
PIECE_TOKENS = 1 << 18
SUFFICIENT = 1e-4
HALVINGS = 20
TOLERANCE = 1e-6
SCORE_DIGITS = 6


def hashed_terms(text: Column, features: int) -> Column:
    """The tokens of a text as feature numbers, with repeats."""
    known = F.filter(tokens(F.coalesce(text, F.lit(""))), lambda t: t != "")
    return F.transform(known, lambda t: F.pmod(F.xxhash64(t), F.lit(features)).cast("int"))


class Rows:
    """Some rows as sparse vectors: row, feature and count of every entry, by row and feature."""

    def __init__(self, lists: pa.ListArray, features: int):
        sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        pairs, self.count = np.unique(row * features + lists.flatten().to_numpy(), return_counts=True)
        self.n, self.row, self.feature = len(sizes), pairs // features, pairs % features

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per row, its entries' values added up; always in the same order."""
        out = np.zeros(self.n)
        if len(values):
            starts = np.flatnonzero(np.diff(self.row, prepend=-1))
            out[self.row[starts]] = np.add.reduceat(values, starts)
        return out

    def vectors(self, idf: np.ndarray) -> np.ndarray:
        """The entries of the unit vectors."""
        x = self.count * idf[self.feature]
        norm = np.sqrt(self.sums(x * x))
        return x / np.where(norm > 0, norm, 1.0)[self.row]


def pieces(lists: pa.ListArray) -> Iterator[tuple[int, int]]:
    """Rows ``start`` to ``end`` that hold at most ``PIECE_TOKENS`` tokens together, or are one row."""
    total = np.cumsum(pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(total):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + PIECE_TOKENS, side="right")))
        yield start, end
        start = end


def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of (label, terms) batches with a bounded number of tokens."""
    for batch in batches:
        for start, end in pieces(batch.column(1)):
            yield batch.slice(start, end - start)


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(margin / 2))


def added_up(rows: DataFrame, share) -> dict[str, np.ndarray]:
    """``share(batches)`` gives whole numbers by feature (and extra keys) for a task; their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, extras = share(in_pieces(batches))
        held = np.flatnonzero(features)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((held, list(extras))).astype(np.int64)),
             pa.array(np.concatenate((features[held], list(extras.values()))).astype(np.int64))],
            names=["key", "value"],
        )
        give_back()

    small_batches(rows.sparkSession)
    # One row per feature at most.
    found = rows.mapInArrow(run, "key long, value long").groupBy("key").agg(F.sum("value").alias("value")).toArrow()
    return {"key": found.column("key").to_numpy(), "value": found.column("value").to_numpy()}


def split(found: dict[str, np.ndarray], features: int, *extras: int) -> tuple[np.ndarray, ...]:
    """Sums by feature, then those of the extra keys."""
    out, own = np.zeros(features, dtype=np.int64), found["key"] >= 0
    out[found["key"][own]] = found["value"][own]
    return out, *(int(found["value"][found["key"] == e].sum()) for e in extras)


@dataclass
class LogisticModel:
    """Weights by feature; ``idf`` belongs to them."""

    coefficients: np.ndarray
    intercept: float
    idf: np.ndarray

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(int(f), float(self.coefficients[f]), float(self.idf[f])) for f in np.flatnonzero(self.idf)]
        rows += [(BIAS, float(self.intercept), float(len(self.idf)))]
        table = spark.createDataFrame(rows, "feature int, coefficient double, idf double")
        table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LogisticModel:
        found = spark.read.parquet(path).toArrow()
        feature, coefficient, idf = (found.column(c).to_numpy() for c in ("feature", "coefficient", "idf"))
        bias, own = feature == BIAS, feature != BIAS
        weights, idfs = (np.zeros(int(idf[bias][0])) for _ in range(2))
        weights[feature[own]], idfs[feature[own]] = coefficient[own], idf[own]
        return LogisticModel(weights, float(coefficient[bias][0]), idfs)


@dataclass
class Iterate:
    """The model after an iteration, and the objective there."""

    model: LogisticModel
    loss: float


class Objective:
    """Mean log loss plus a penalty on the weights (not on the intercept), over stored rows."""

    def __init__(self, rows: DataFrame, features: int, reg: float):
        self.rows, self.features, self.reg = rows, features, reg

        def share(batches: Iterator[pa.RecordBatch]):
            df, n = np.zeros(features, dtype=np.int64), 0
            for batch in batches:
                own = Rows(batch.column(1), features)
                df += np.bincount(own.feature, minlength=features)
                n += own.n
            return df, {ROWS: n}

        df, self.n = split(added_up(rows, share), features, ROWS)
        self.idf = np.where(df > 0, np.log((self.n + 1) / (df + 1)), 0.0)

    def __call__(self, point: np.ndarray) -> tuple[float, np.ndarray]:
        """Value and gradient at a point (weights, then the intercept): one pass."""
        features = self.features
        known = self.rows.sparkSession.sparkContext.broadcast((point, self.idf))

        def share(batches: Iterator[pa.RecordBatch]):
            w, idf = known.value
            gradient, bias, loss = np.zeros(features, dtype=np.int64), 0, 0
            for batch in batches:
                own, y = Rows(batch.column(1), features), batch.column(0).to_numpy(zero_copy_only=False)
                x = own.vectors(idf)
                margin = own.sums(x * w[own.feature]) + w[-1]
                off = sigmoid(margin) - y
                # Whole numbers far below 2**53, so these sums of doubles are exact.
                units = np.rint(off[own.row] * x * UNIT)
                gradient += np.bincount(own.feature, weights=units, minlength=features).astype(np.int64)
                bias += int(np.rint(off * UNIT).sum())
                loss += int(np.rint((np.logaddexp(0, margin) - y * margin) * UNIT).sum())
            return gradient, {BIAS: bias, LOSS: loss}

        gradient, bias, loss = split(added_up(self.rows, share), features, BIAS, LOSS)
        known.destroy()
        slope = np.append(gradient, bias) / UNIT / self.n
        slope[:-1] += self.reg * point[:-1]
        return loss / UNIT / self.n + 0.5 * self.reg * dot(point[:-1], point[:-1]), slope


def dot(a: np.ndarray, b: np.ndarray) -> float:
    """By numpy's own sum, whose order does not depend on the number of threads."""
    return float((a * b).sum())


def direction(slope: np.ndarray, seen: deque) -> np.ndarray:
    """The L-BFGS direction from the remembered steps and changes of the gradient."""
    q, used = -slope, []
    for step, change, size in reversed(seen):
        a = dot(step, q) / size
        q = q - a * change
        used.append(a)
    if seen:
        _, change, size = seen[-1]
        q = q * (size / dot(change, change))
    for (step, change, size), a in zip(seen, reversed(used)):
        q = q + (a - dot(change, q) / size) * step
    return q


def minimise(objective, start: np.ndarray, max_iter: int) -> Iterator[tuple[np.ndarray, float]]:
    """Point and value before the first and after every iteration."""
    point, (value, slope), seen = start, objective(start), deque(maxlen=MEMORY)
    yield point, value
    for _ in range(max_iter):
        if np.sqrt(dot(slope, slope)) <= TOLERANCE * max(1.0, np.sqrt(dot(point, point))):
            return
        way = direction(slope, seen)
        if dot(way, slope) >= 0:
            seen.clear()
            way = -slope
        size = 1.0
        for _ in range(HALVINGS):
            new_point = point + size * way
            new_value, new_slope = objective(new_point)
            if new_value <= value + SUFFICIENT * size * dot(way, slope):
                break
            size /= 2
        else:
            return
        step, change = new_point - point, new_slope - slope
        if dot(step, change) > 0:
            seen.append((step, change, dot(step, change)))
        point, value, slope = new_point, new_value, new_slope
        yield point, value


def training_rows(examples: DataFrame, features: int) -> DataFrame:
    """``label, terms`` of the examples that have a label, stored."""
    positive = (F.try_element_at("cats", F.lit(POSITIVE)) >= 0.5).cast("double")
    rows = examples.select(positive.alias("label"), hashed_terms(F.col("text"), features).alias("terms"))
    return materialise(rows.where(F.col("label").isNotNull()), "training")


def fit(examples: DataFrame, features: int = FEATURES, max_iter: int = 20, reg: float = 0.01) -> list[Iterate]:
    """The models before the first and after every iteration, from ``text`` and ``cats``."""
    objective = Objective(training_rows(examples, features), features, reg)
    if objective.n == 0:
        raise ValueError("no labelled examples")
    return [
        Iterate(LogisticModel(point[:-1], float(point[-1]), objective.idf), value)
        for point, value in minimise(objective, np.zeros(features + 1), max_iter)
    ]


def scores(docs: DataFrame, models: list[LogisticModel], text: str) -> Column:
    """An array column with the score of every model, in one scan; no shuffle."""
    features = len(models[0].idf)
    weights = np.column_stack([np.append(m.coefficients, m.intercept) for m in models])
    known = docs.sparkSession.sparkContext.broadcast((weights, models[0].idf))
    kind = pa.list_(pa.float64())
    small_batches(docs.sparkSession)

    def score(terms: pa.Array) -> pa.Array:
        w, idf = known.value
        parts = []
        for start, end in pieces(terms):
            own = Rows(terms.slice(start, end - start), features)
            x = own.vectors(idf)
            found = [sigmoid(own.sums(x * w[own.feature, k]) + w[-1, k]) for k in range(w.shape[1])]
            parts.append(pa.array(list(np.round(np.column_stack(found), SCORE_DIGITS)), type=kind))
        give_back()
        return pa.concat_arrays(parts or [pa.array([], type=kind)])

    return F.arrow_udf(score, "array<double>")(hashed_terms(F.col(text), features))
