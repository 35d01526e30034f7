"""Logistic regression with an L2 penalty, by Newton steps on sums over all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import ship_package

TOLERANCE = 1e-10


@dataclass
class Logistic:
    """Weights of the columns and the intercept; ``steps`` passes were needed."""

    features: list[str]
    weights: np.ndarray
    intercept: float
    steps: int = 0

    def margin(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.weights):
            out = out + F.col(f"`{c}`") * F.lit(float(w))
        return out

    def transform(self, df: DataFrame, probability: str = "probability_1", prediction: str = "prediction") -> DataFrame:
        """Add P(class 1) and the more likely class: a projection of built-in functions."""
        z = self.margin()
        return df.withColumn(probability, 1 / (1 + F.exp(-z))).withColumn(prediction, (z > 0).cast("double"))


def _sums(data: DataFrame, d: int, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and second derivatives over all rows; every Arrow batch is one matrix product."""
    upper = np.triu_indices(d + 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, slope, bend = 0.0, np.zeros(d + 1), np.zeros((d + 1, d + 1))
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(d)] + [np.ones(b.num_rows)])
            y = b.column(d).to_numpy(zero_copy_only=False)
            z = x @ beta
            p = 0.5 * (1 + np.tanh(z / 2))
            loss += float(np.sum(np.logaddexp(0, z) - y * z))
            slope += x.T @ (p - y)
            bend += (x * (p * (1 - p))[:, None]).T @ x
        values = np.concatenate([[loss], slope, bend[upper]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], ["i", "v"])

    rows = data.mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()  # (d + 2)(d + 3) / 2 numbers or so
    out = np.zeros(1 + (d + 1) + len(upper[0]))
    for r in rows:
        out[r["i"]] = r["v"]
    bend = np.zeros((d + 1, d + 1))
    bend[upper] = out[d + 2:]
    return out[0], out[1:d + 2], bend + np.triu(bend, 1).T


def fit_logistic(
    df: DataFrame, cols: Sequence[str], label: str, penalty: float = 1.0, max_steps: int = 100, tolerance: float = TOLERANCE,
) -> Logistic:
    """Minimise the summed loss plus ``penalty / 2`` times the squared weights; the intercept is free.

    ``df`` is read once a step, so store it first if it is costly. A step that does not lower the loss is halved. The fit
    ends when no part of the gradient exceeds ``tolerance`` times the number of rows, and is an error if ``max_steps`` are not
    enough, or if there is only one class: then no intercept is best.
    """
    ship_package(df.sparkSession)
    cols = list(cols)
    d = len(cols)
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col(label).cast("double").alias("y"))
    shape = data.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones")).first()
    if not shape["n"] or not 0 < shape["ones"] < shape["n"]:
        raise ValueError("needs rows of both classes")
    ridge = np.append(np.full(d, float(penalty)), 0.0)
    share = shape["ones"] / shape["n"]
    beta, before, move = np.append(np.zeros(d), np.log(share / (1 - share))), np.inf, None
    for step in range(1, max_steps + 1):
        loss, slope, bend = _sums(data, d, beta)
        loss += float(ridge @ (beta * beta)) / 2
        if move is not None and loss > before + 1e-12 * abs(before):
            move = move / 2
            beta = beta - move
            continue
        slope = slope + ridge * beta
        if np.abs(slope).max() <= tolerance * shape["n"]:
            return Logistic(cols, beta[:d], float(beta[d]), step)
        move = -np.linalg.lstsq(bend + np.diag(ridge), slope, rcond=None)[0]  # a constant column has no curvature of its own
        before, beta = loss, beta + move
    raise RuntimeError(f"no optimum after {max_steps} steps")


def gradient(df: DataFrame, fit: Logistic, label: str, penalty: float = 1.0) -> DataFrame:
    """Rows (feature, gradient): the penalised loss differentiated by every weight, by built-in functions. At the optimum all are 0."""
    error = 1 / (1 + F.exp(-fit.margin())) - F.col(label)
    sums = df.agg(*[F.sum(error * F.col(f"`{c}`")).alias(f"g{i}") for i, c in enumerate(fit.features)], F.sum(error).alias("g"))
    rows = [F.struct(F.lit(c).alias("feature"), (F.col(f"g{i}") + F.lit(float(penalty * w))).alias("gradient"))
            for i, (c, w) in enumerate(zip(fit.features, fit.weights))]
    return sums.select(F.inline(F.array(*rows, F.struct(F.lit("intercept").alias("feature"), F.col("g").alias("gradient")))))
