"""Quality classifier: Naive Bayes support vectors.

Features say whether an n-gram occurs in a text: byte trigrams, words, word pairs, and which of four words in a row
equal the next; all hashed to ``SLOTS``. Each is scaled by its class log-count ratio, the rows to unit length, and
a linear hinge-loss model is fitted by dual coordinate descent. A logistic curve over margins of rows that the model
has not seen turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churn_engine.llm import words
from churn_engine.llm.common import in_slices, small_batches, store, text_bytes

SLOTS = 1 << 18
SHIFT = np.uint64(64 - 18)
#: The most labelled rows that a model is fitted on, drawn by a hash of their id; a documented bound, not a cut of what is scored.
SAMPLE = 6000
#: Every so-manieth row of the sample sets the logistic curve and is left out of the fit.
CALIBRATE = 4
THRESHOLD = 0.3


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Features:
    """The slots of n-grams in each text of a column."""

    def __init__(self):
        self.seen = np.zeros(SLOTS, bool)
        self.patterns = (words.mixed(np.arange(100, 108, dtype=np.uint64)) >> SHIFT).astype(np.int32)

    def __call__(self, column: pa.Array) -> Iterator[np.ndarray]:
        data, offsets = text_bytes(column)
        starts, ends, first = words.word_spans(data, offsets)
        hashes = words.span_hashes(data, starts, ends)
        single = (hashes >> SHIFT).astype(np.int32)
        pair = hashes[:-1] * words.BASE + hashes[1:]
        pair[hashes[:-1] == hashes[1:]] = np.uint64(1)
        pairs = (words.mixed(pair) >> SHIFT).astype(np.int32)
        same = (hashes[:-1] == hashes[1:]).astype(np.int8)
        repeats = self.patterns[same[:-2] + 2 * same[1:-1] + 4 * same[2:]]
        code = data.astype(np.uint64)
        grams = (code[:-2] << np.uint64(16)) | (code[1:-1] << np.uint64(8)) | code[2:] if len(code) > 2 else np.zeros(0, np.uint64)
        grams = ((grams + np.uint64(1)) * words.BASE >> SHIFT).astype(np.int32)
        for row in range(len(offsets) - 1):
            a, b, x, y = offsets[row], offsets[row + 1], first[row], first[row + 1]
            self.seen[grams[a : max(a, b - 2)]] = True
            self.seen[single[x:y]] = True
            self.seen[pairs[x : max(x, y - 1)]] = True
            self.seen[repeats[x : max(x, y - 3)]] = True
            found = np.flatnonzero(self.seen).astype(np.int32)
            self.seen[found] = False
            yield found


@dataclass
class Model:
    """Weights per slot (already scaled by the ratios), the ratios' squares for the row length, bias, logistic curve."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        length = float(self.squares[found].sum(dtype=np.float64)) if len(found) else 0.0
        return self.bias + (float(self.weights[found].sum(dtype=np.float64)) / np.sqrt(length) if length > 0 else 0.0)

    def score(self, found: np.ndarray) -> float:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.offset, -500, 500)))


def log_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """ln of the smoothed share of a slot among class 1 by that among class 0."""
    counts = np.ones((2, SLOTS))
    for found, label in zip(rows, labels.tolist(), strict=True):
        counts[label, found] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, cost: float = 1.0, epochs: int = 10) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model; each row has unit length and a constant feature besides."""
    rng = np.random.default_rng(11)
    w, bias, alpha = np.zeros(SLOTS), 0.0, np.zeros(len(rows))
    squared = np.array([float(v @ v) + 1 for v in values])
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)).tolist():
            gradient = signs[i] * (float(w[rows[i]] @ values[i]) + bias) - 1
            after = min(max(alpha[i] - gradient / squared[i], 0.0), cost)
            step = (after - alpha[i]) * signs[i]
            if step:
                alpha[i] = after
                w[rows[i]] += step * values[i]
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return w, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with smoothed targets so that separable rows don't diverge."""
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    theta = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def train(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """With one class, or none, the share of class 1 is the score of every text."""
    flat = Model(np.zeros(SLOTS, np.float32), np.zeros(SLOTS, np.float32), 0.0, 1.0, float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))))
    used = np.arange(len(rows)) % CALIBRATE != 0
    if min(np.bincount(labels[used], minlength=2)) == 0 or min(np.bincount(labels[~used], minlength=2)) == 0:
        return flat
    ratios = log_ratios([r for r, u in zip(rows, used, strict=True) if u], labels[used])
    squares = (ratios**2).astype(np.float32)
    fit = [r for r, u in zip(rows, used, strict=True) if u]
    values = [ratios[r] / max(np.sqrt((ratios[r] ** 2).sum()), 1e-12) for r in fit]
    w, bias = dual_coordinate_descent(fit, values, np.where(labels[used] == 1, 1.0, -1.0))
    model = Model((w * ratios).astype(np.float32), squares, bias, 1.0, 0.0)
    margins = np.array([model.margin(r) for r, u in zip(rows, used, strict=True) if not u])
    model.slope, model.offset = logistic(margins, labels[~used])
    return model


def _trained(key: tuple, sample: pa.Table) -> pa.Table:
    order = np.argsort(np.asarray(sample["rank"]), kind="stable")
    rows = [np.asarray(sample["found"][int(i)].values) for i in order]
    model = train(rows, np.asarray(sample["label"])[order])
    return pa.table(
        {
            "weights": pa.array([model.weights.tobytes()], pa.binary()),
            "squares": pa.array([model.squares.tobytes()], pa.binary()),
            "bias": [model.bias],
            "slope": [model.slope],
            "offset": [model.offset],
        }
    )


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """A model of the labelled rows that are not held out. The sample is bounded, so its ids can be sent to all tasks, and one
    task holds its features."""
    small_batches(docs.sparkSession)
    told = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    told = told.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id"))
    # An id with both labels says nothing.
    told = told.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    drawn = told.select("id", "label", F.xxhash64("id").alias("rank")).orderBy("rank", "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(store(drawn)), "id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in in_slices(batches, "text", 1 << 19):
            found = pa.array([x.tolist() for x in features(batch.column("text"))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column("label"), found], names=["rank", "label", "found"])

    features = rows.mapInArrow(extract, "rank long, label int, found array<int>")
    schema = "weights binary, squares binary, bias double, slope double, offset double"
    told = features.groupBy(F.lit(0).alias("one")).applyInArrow(_trained, schema).collect()
    if not told:
        return train([], np.zeros(0, np.int64))
    (x,) = told
    return Model(np.frombuffer(x.weights, np.float32), np.frombuffer(x.squares, np.float32), x.bias, x.slope, x.offset)


def _scored(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in in_slices(batches, "text", 1 << 19):
            scores = [model.score(found) for found in features(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], names=["id", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, held_out, score, predicted``; no shuffle.

    Defined cases: null and empty texts get the score of a text without features; null ids stay null and are not
    held out; repeated rows get equal scores; an empty table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(_scored(model), f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_poor(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model of ``labels`` predicts as 1, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in in_slices(batches, text_col, 1 << 19):
            kept = [model.score(found) >= THRESHOLD for found in features(batch.column(text_col))]
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema).select(*names)
