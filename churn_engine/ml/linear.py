"""Logistic regressions of many candidates and folds at once: each pass over the rows serves all of them.

A search fits the same few columns under several penalties on several parts of the rows. Fitted one by one, each is hundreds of small
jobs. Here a pass sums the loss, gradient and Hessian of every fit, a task hands on one row per fit whatever its rows, and the driver, which
holds columns x columns numbers a fit, takes a proximal Newton step for each: damped, by coordinate descent under an l1 penalty.

The objective is that of MLlib without standardisation: the weighted mean log loss + regParam * (elasticNetParam * |w|_1 +
(1 - elasticNetParam) / 2 * |w|^2), the intercept free. Columns are centred and scaled for the arithmetic only; penalties follow.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors need not have this package: the task functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A fit ends where a step promises less than this share of the objective.
TOLERANCE = 1e-9
#: Sweeps of coordinate descent in a step; a step cut short is still a descent.
SWEEPS = 2000


@dataclass(frozen=True)
class Task:
    """One fit: the fold it leaves out, the weights of classes 0 and 1, their sum over its rows, penalties, and the most steps."""

    fold: int
    weights: tuple[float, float]
    total: float
    reg: float
    mix: float
    steps: int


def class_weights(scheme: str | float | None, negatives: int, positives: int) -> tuple[float, float]:
    """The weights that ``with_class_weight`` gives to the two classes."""
    if scheme == "balanced":
        return (negatives + positives) / (2 * negatives), (negatives + positives) / (2 * positives)
    if scheme == "positive":
        return 1.0, negatives / positives
    return 1.0, 1.0 if scheme is None else float(scheme)


class Columns:
    """Reads a batch as a matrix of centred, scaled columns, the last one all ones."""

    def __init__(self, rows: DataFrame, features: Sequence[str]):
        moments = rows.agg(*[F.avg(c).cast("double") for c in features], *[F.stddev_pop(c).cast("double") for c in features]).first()
        self.n = len(features)
        self.mean, self.scale = (np.array([np.nan if v is None else v for v in part]) for part in (moments[: self.n], moments[self.n :]))
        self.scale = np.where(self.scale > 0, self.scale, 1.0)

    def __call__(self, batch: pa.RecordBatch) -> np.ndarray:
        x = np.ones((batch.num_rows, self.n + 1))
        for i in range(self.n):
            x[:, i] = (batch.column(i).to_numpy(zero_copy_only=False) - self.mean[i]) / self.scale[i]
        if np.isnan(x).any():
            raise ValueError("null or NaN in a feature")
        return x


def _sums(columns: Columns, tasks: Sequence[Task], points: np.ndarray) -> Callable:
    """Per fit, the loss, gradient and Hessian over the rows of a Spark task."""
    left_out = np.array([t.fold for t in tasks])
    zero, one = (np.array([t.weights[c] for t in tasks]) for c in (0, 1))
    k, d = points.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, hessian = np.zeros(k), np.zeros((k, d)), np.zeros((k, d, d))
        for batch in batches:
            x, y, fold = columns(batch), *(batch.column(c).to_numpy(zero_copy_only=False)[:, None] for c in ("label", "fold"))
            weight = np.where(y > 0, one, zero) * (fold != left_out)
            margin = x @ points.T
            loss += (weight * (np.logaddexp(0, margin) - y * margin)).sum(axis=0)
            p = (1 + np.tanh(margin / 2)) / 2
            gradient += (weight * (p - y)).T @ x
            curve = weight * p * (1 - p)
            for i in range(k):
                hessian[i] += x.T @ (x * curve[:, i : i + 1])
        sums = np.concatenate([loss[:, None], gradient, hessian.reshape(k, -1)], axis=1)
        lists = pa.ListArray.from_arrays(np.arange(0, sums.size + 1, sums.shape[1], dtype=np.int32), pa.array(sums.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), lists], names=["fit", "sums"])

    return run


def _added(parts: pa.Table) -> pa.Table:
    total = parts["sums"].combine_chunks().flatten().to_numpy().reshape(parts.num_rows, -1).sum(axis=0)
    return pa.table({"fit": parts["fit"][:1], "sums": pa.array([total])})


def _direction(gradient: np.ndarray, hessian: np.ndarray, l1: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Steps (fits x columns) to the minima of the quadratic models with their l1 penalties."""
    diagonal = np.einsum("kii->ki", hessian)
    diagonal += 1e-12 + 1e-12 * diagonal.mean(axis=1, keepdims=True)
    out = np.zeros_like(point)
    plain = ~(l1 > 0).any(axis=1)
    if plain.any():
        out[plain] = -np.linalg.solve(hessian[plain], gradient[plain][:, :, None])[:, :, 0]
    if plain.all():
        return out
    h, l1, start = hessian[~plain], l1[~plain], point[~plain]
    z, slope, own = start.copy(), gradient[~plain].copy(), np.einsum("kii->ki", h)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(z.shape[1]):
            free = own[:, j] * z[:, j] - slope[:, j]
            step = np.sign(free) * np.maximum(np.abs(free) - l1[:, j], 0) / own[:, j] - z[:, j]
            z[:, j] += step
            slope += h[:, :, j] * step[:, None]
            moved = max(moved, float((own[:, j] * step * step).max()))
        if moved < 1e-14:
            break
    out[~plain] = z - start
    return out


def fit_together(rows: DataFrame, tasks: Sequence[Task], features: Sequence[str], label: str) -> tuple[Columns, np.ndarray]:
    """Fit all tasks on ``rows`` (features, label 0 or 1, ``fold``): the columns' reader, and for each fit its coefficients there, the
    intercept last."""
    columns = Columns(rows, features)
    data = rows.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("label"), F.col("fold").cast("long").alias("fold"))
    k, d = len(tasks), len(features) + 1
    reg, mix = (np.array([getattr(t, name) for t in tasks])[:, None] for name in ("reg", "mix"))
    l1 = np.hstack([reg * mix / columns.scale, np.zeros((k, 1))])
    l2 = np.hstack([reg * (1 - mix) / columns.scale**2, np.zeros((k, 1))])
    point, trial, direction = (np.zeros((k, d)) for _ in range(3))
    value, promised, length, taken = np.full(k, np.inf), np.zeros(k), np.ones(k), np.zeros(k, int)
    active = np.arange(k)
    while len(active):
        some = [tasks[i] for i in active]
        parts = data.mapInArrow(_sums(columns, some, trial[active]), "fit long, sums array<double>")
        found = parts.groupBy("fit").applyInArrow(_added, "fit long, sums array<double>").toArrow().sort_by("fit")
        sums = found["sums"].combine_chunks().flatten().to_numpy().reshape(len(active), -1) / np.array([t.total for t in some])[:, None]
        reached = sums[:, 0] + (l2[active] * trial[active] ** 2).sum(axis=1) / 2 + (l1[active] * np.abs(trial[active])).sum(axis=1)
        good = reached <= value[active] + 1e-4 * length[active] * promised[active]
        length[active[~good]] /= 2
        new = active[good]
        point[new], value[new] = trial[new], reached[good]
        taken[new] += 1
        gradient = sums[good, 1 : d + 1] + l2[new] * point[new]
        hessian = sums[good, d + 1 :].reshape(-1, d, d) + np.eye(d) * l2[new][:, None, :]
        direction[new] = _direction(gradient, hessian, l1[new], point[new])
        promised[new] = (gradient * direction[new]).sum(axis=1) + (l1[new] * (np.abs(point[new] + direction[new]) - np.abs(point[new]))).sum(axis=1)
        length[new] = 1.0
        ended = (promised > -TOLERANCE * np.maximum(value, 1e-3)) | (length < 1e-6) | (taken > [t.steps for t in tasks])
        active = active[~ended[active]]
        trial[active] = point[active] + length[active, None] * direction[active]
    return columns, point


def margins(rows: DataFrame, columns: Columns, points: np.ndarray, features: Sequence[str], label: str) -> DataFrame:
    """(label, fold, margins): for each row the margins under ``points[fold]``, one fit a row."""
    data = rows.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("label"), F.col("fold").cast("int").alias("fold"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fold = columns(batch), batch.column("fold").to_numpy(zero_copy_only=False)
            out = np.zeros((len(x), points.shape[1]))
            for f in np.unique(fold):
                out[fold == f] = x[fold == f] @ points[f].T
            lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("fold"), lists], names=["label", "fold", "margins"])

    return data.mapInArrow(run, "label double, fold int, margins array<double>")
