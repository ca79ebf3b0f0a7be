"""Toxicity by a classifier chain.

Categories are predicted one after the other. Each link is a logistic model on indicators
of words and word beginnings and on the probabilities of the categories before it. For training, those come
from out-of-fold predictions, so a later link learns from probabilities as uncertain as
the ones it will see. Words take part in a link if their presence differs between the
classes beyond chance (chi-square), which keeps the many rare words of long texts out.

The fit uses a bounded sample of labelled rows (``SAMPLE_ROWS``, ids of least hash);
scoring is row by row over all texts with one weight for each bucket and category.

Defined results: NULL and empty texts have no words and get the intercepts' probability;
repeated rows are scored each; a category without labels of both classes gets the share
of its ones (0 without any label); very long texts are scored whole; an empty table gives an empty
one; columns named like a probability are replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.indicators import (
    BUCKETS, SAMPLE_ROWS, WordIndicators, fitted, labelled_features, labelled_sample,
)
from reelmill.llm.words import by_bytes, text_bytes

FOLDS = 3
CHI_SQUARE = 15.1           # a word's statistic from which chance is below 1 in 10,000
PENALTY = 0.3
NEWTON_STEPS = 15
GRADIENT_STEPS = 40
REJECT = 0.3                # probability of the last category from which a text is rejected


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_odds(p: np.ndarray) -> np.ndarray:
    return np.log(p + 1e-6) - np.log(1 - p + 1e-6)


def telling(rows: Sequence[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Buckets whose presence differs between the classes (chi-square with correction)."""
    flat = np.concatenate(rows) if len(rows) else np.empty(0, dtype=np.int32)
    ones = np.repeat(label, [len(r) for r in rows])
    a = np.bincount(flat[ones > 0], minlength=BUCKETS).astype(float)
    b = np.bincount(flat[ones == 0], minlength=BUCKETS).astype(float)
    c, d = label.sum() - a, len(label) - label.sum() - b
    excess = np.maximum(np.abs(a * d - b * c) - len(label) / 2, 0)
    below = (a + b) * (c + d) * (a + c) * (b + d)
    statistic = np.where(below > 0, len(label) * excess**2 / np.where(below > 0, below, 1), 0)
    return np.flatnonzero(statistic >= CHI_SQUARE)


class Design:
    """The telling words' indicators and the dense rest of all rows, as a linear map."""

    def __init__(self, rows: Sequence[np.ndarray], words: np.ndarray, rest: np.ndarray) -> None:
        place = np.full(BUCKETS, -1)
        place[words] = np.arange(len(words))
        column = place[np.concatenate(rows)]
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.owner, self.column = owner[column >= 0], column[column >= 0]
        self.rest, self.size, self.words = rest, len(rows), len(words)

    def scores(self, at: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.owner, at[self.column], self.size)
        return sparse + self.rest @ at[self.words :]

    def sums(self, weight: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.column, weight[self.owner], self.words)
        return np.append(sparse[: self.words], weight @ self.rest)


def newton(design: Design, label: np.ndarray, at: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Least penalised logistic loss; each Newton step is solved by conjugate gradients."""

    def loss(w: np.ndarray, z: np.ndarray) -> float:
        return float((np.logaddexp(0, z) - label * z).sum() + 0.5 * (penalty * w * w).sum())

    z = design.scores(at)
    for _ in range(NEWTON_STEPS):
        p = sigmoid(z)
        slope = design.sums(p - label) + penalty * at
        curve = p * (1 - p)
        step, left = np.zeros(len(at)), -slope
        ahead, size = left.copy(), float(left @ left)
        goal = size * 1e-4
        for _ in range(GRADIENT_STEPS):
            if size <= goal:
                break
            bent = design.sums(curve * design.scores(ahead)) + penalty * ahead
            pace = size / float(ahead @ bent)
            step += pace * ahead
            left -= pace * bent
            fresh = float(left @ left)
            ahead, size = left + fresh / size * ahead, fresh
        before, pace, moved = loss(at, z), 1.0, design.scores(step)
        while loss(at + pace * step, z + pace * moved) > before and pace > 1e-3:
            pace /= 2
        at, z = at + pace * step, z + pace * moved
        if before - loss(at, z) < 1e-6 * (1 + before):
            break
    return at


def link_fit(rows: Sequence[np.ndarray], earlier: np.ndarray, label: np.ndarray) -> dict:
    """One link: weights of the telling words, of earlier log-odds, and an intercept."""
    if len(set(label.tolist())) < 2:
        share = label.mean() if len(label) else 0.0
        bias = float(log_odds(np.array(share)))
        none = np.empty(0, dtype=np.int64)
        return {"words": none, "weights": np.empty(0), "chain": np.zeros(earlier.shape[1]), "bias": bias}
    words = telling(rows, label)
    design = Design(rows, words, np.concatenate([earlier, np.ones((len(rows), 1))], axis=1))
    start = np.zeros(len(words) + earlier.shape[1] + 1)
    start[-1] = log_odds(np.array(label.mean()))
    penalty = np.full(len(start), PENALTY)
    penalty[-1] = 1e-6
    at = newton(design, label, start, penalty)
    split = len(words)
    return {"words": words, "weights": at[:split], "chain": at[split:-1], "bias": float(at[-1])}


def link_scores(link: dict, rows: Sequence[np.ndarray], earlier: np.ndarray) -> np.ndarray:
    weight = np.zeros(BUCKETS)
    weight[link["words"]] = link["weights"]
    z = np.array([weight[row].sum() for row in rows])
    return sigmoid(z + earlier @ link["chain"] + link["bias"])


def fit_chain(labels: np.ndarray, rows: list[np.ndarray]) -> bytes:
    """All links, each trained on out-of-fold log-odds of the ones before it."""
    categories = labels.shape[1] if labels.ndim == 2 else 0
    earlier = np.zeros((len(rows), 0))
    fold = np.arange(len(rows)) % FOLDS
    links = []
    for c in range(categories):
        label = labels[:, c]
        links.append(link_fit(rows, earlier, label))
        p = np.zeros(len(rows))
        for k in range(FOLDS):
            inner, outer = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            link = link_fit([rows[i] for i in inner], earlier[inner], label[inner])
            p[outer] = link_scores(link, [rows[i] for i in outer], earlier[outer])
        earlier = np.concatenate([earlier, log_odds(p)[:, None]], axis=1)
    return pickle.dumps(links)


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> bytes:
    """The chain over the 0/1 columns ``categories`` of ``labels``, in that order."""
    columns = list(categories)
    sample = labelled_sample(labels, doc_id, columns, sample_rows)
    return fitted(labelled_features(docs, sample, doc_id, text, columns, WordIndicators), fit_chain)


def score(docs: DataFrame, model: bytes, categories: Sequence[str], text: str = "text") -> DataFrame:
    """``docs`` with a probability for each category (``p_<category>``)."""
    names = [f"p_{c}" for c in categories]
    taken = {n.lower() for n in names}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken or f.name == text]
    schema = T.StructType([*kept, *[T.StructField(n, T.DoubleType()) for n in names]])
    arrow = to_arrow_schema(schema)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = pickle.loads(model)
        known = np.unique(np.concatenate([np.empty(0, dtype=np.int64), *(link["words"] for link in links)]))
        weights = np.zeros((len(names), len(known)))
        for row, link in zip(weights, links):
            row[np.searchsorted(known, link["words"])] = link["weights"]
        of = WordIndicators()
        for batch in by_bytes(batches, text):
            sums = np.zeros((batch.num_rows, len(names)))
            for k, value in enumerate(text_bytes(batch.column(text))):
                row = of(value)
                place = np.searchsorted(known, row[np.isin(row, known, assume_unique=True)])
                sums[k] = weights[:, place].sum(axis=1)
            earlier = np.zeros((len(sums), 0))
            found = []
            for c in range(len(names)):
                link = links[c] if c < len(links) else None
                p = sigmoid(sums[:, c] + earlier @ link["chain"] + link["bias"]) if link else np.zeros(len(sums))
                found.append(p)
                earlier = np.concatenate([earlier, log_odds(p)[:, None]], axis=1)
            columns = [*[batch.column(f.name) for f in kept], *[pa.array(p, pa.float64()) for p in found]]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(scored, schema)


def chain_labels(labels: DataFrame) -> DataFrame:
    """The label table's judgements as chain categories: ``junk`` first, then ``toxic``."""
    return labels.where("quality IN (0, 1) AND toxic IN (0, 1)").select(
        "doc_id", (1 - F.col("quality")).alias("junk"), "toxic"
    )
