"""Quality classifier: naive Bayes support vector machine.

N-gram indicators are scaled by the log-count ratio of the classes; a linear hinge-loss
model on them is fitted by dual coordinate descent. Margins become scores through a
logistic curve fitted on out-of-fold margins. The fit uses a bounded sample of labelled
rows (``SAMPLE_ROWS``, the ids of least hash); scoring is row by row over all texts, with
one weight for each of 2^20 buckets, whatever the data's size.

Defined results: NULL and empty texts have no indicators and get the intercept's score;
repeated rows are scored each; rows without an id are scored and count as not held out;
without labels of both classes every score is the share of label 1 (0.5 without any); very long
texts are scored whole; an empty table gives an empty one; a column named like the score is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.indicators import (
    BUCKETS, SAMPLE_ROWS, NgramIndicators, fitted, labelled_features, labelled_sample,
)
from reelmill.llm.words import text_bytes

COST = 0.1                  # upper bound of a dual variable
EPOCHS = 10
FOLDS = 3
SMOOTHING = 1.0


def log_count_ratio(rows: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    counts = np.full((2, BUCKETS), SMOOTHING)
    for row, value in zip(rows, label):
        counts[value, row] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def hinge_fit(rows: list[np.ndarray], label: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Weights over raw indicators, the intercept last, by dual coordinate descent."""
    sign = np.where(label > 0, 1.0, -1.0)
    square = [float(ratio[row] @ ratio[row]) + 1.0 for row in rows]
    dual, weight, bias = np.zeros(len(rows)), np.zeros(BUCKETS), 0.0
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            row = rows[k]
            scale = ratio[row]
            slope = sign[k] * (weight[row] @ scale + bias) - 1.0
            value = min(max(dual[k] - slope / square[k], 0.0), COST)
            if value != dual[k]:
                step = (value - dual[k]) * sign[k]
                weight[row] += step * scale
                bias += step
                dual[k] = value
    return np.append(weight * ratio, bias)


def margins(rows: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
    return np.array([weight[row].sum() + weight[-1] for row in rows])


def logistic_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margin to probability (Newton steps).

    Targets are drawn in from 0 and 1 by the class counts, so separable margins keep a
    finite slope.
    """
    ones = int(label.sum())
    zeros = len(label) - ones
    target = np.where(label > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    at = np.array([1.0, np.log((ones + 1) / (zeros + 1))])
    inputs = np.stack([margin, np.ones(len(margin))], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(inputs @ at, -30, 30)))
        hessian = (inputs * (p * (1 - p) + 1e-9)[:, None]).T @ inputs + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, inputs.T @ (target - p) - 1e-6 * at)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(at[0], 0.0)), float(at[1])


def fit_scores(labels: np.ndarray, rows: list[np.ndarray]) -> bytes:
    """Weights, intercept, slope and offset as float64 bytes."""
    label = labels[:, 0] if len(labels) else np.empty(0, dtype=np.int64)
    if len(set(label.tolist())) < 2:
        share = np.clip(label.mean() if len(label) else 0.5, 1e-6, 1 - 1e-6)
        return np.append(np.zeros(BUCKETS + 2), np.log(share / (1 - share))).tobytes()
    fold = np.empty(len(rows), dtype=np.int64)
    for value in (0, 1):
        of_class = np.flatnonzero(label == value)
        fold[of_class] = np.arange(len(of_class)) % FOLDS
    margin = np.zeros(len(rows))
    for k in range(FOLDS):
        inner, outer = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        part = [rows[i] for i in inner]
        if len(set(label[inner].tolist())) < 2:
            continue
        weight = hinge_fit(part, label[inner], log_count_ratio(part, label[inner]))
        margin[outer] = margins([rows[i] for i in outer], weight)
    weight = hinge_fit(rows, label, log_count_ratio(rows, label))
    return np.concatenate([weight, logistic_curve(margin, label)]).tobytes()


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> bytes:
    """The model of ``labels (doc_id, label 0 or 1)`` as bytes (8 MB)."""
    sample = labelled_sample(labels.where(F.col(label).isin(0, 1)), doc_id, [label], sample_rows)
    return fitted(labelled_features(docs, sample, doc_id, text, [label], NgramIndicators), fit_scores)


def score(docs: DataFrame, model: bytes, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text, in place of a column of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name.lower() != into.lower() or f.name == text]
    schema = T.StructType([*kept, T.StructField(into, T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.frombuffer(shared.value)
        weight, (slope, offset) = numbers[:-2], numbers[-2:]
        of = NgramIndicators()
        for batch in batches:
            margin = margins([of(value) for value in text_bytes(batch.column(text))], weight)
            value = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
            columns = [*[batch.column(f.name) for f in kept], pa.array(value, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(scored, schema)
