"""Least squares on any number of columns, by sums of centred products over all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import ship_package

#: Directions of a share of the largest variance below this are no directions: dependent columns share their weight.
RANK = 1e-11


@dataclass
class Linear:
    features: list[str]
    weights: np.ndarray
    intercept: float

    def line(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.weights):
            out = out + F.col(f"`{c}`") * F.lit(float(w))
        return out

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.line())


def fit_linear(df: DataFrame, cols: Sequence[str], label: str) -> Linear:
    """The weights of least squared error and, where columns depend on each other, of least length; two passes.

    A pass for the means, and one for (d + 1)² sums of products, a matrix product per Arrow batch. NULLs are an error: impute or drop them first.
    """
    ship_package(df.sparkSession)
    cols = list(cols)
    d = len(cols)
    names = [f"x{i}" for i in range(d)] + ["y"]
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip([*cols, label], names)])
    stats = data.agg(F.count(F.lit(1)).alias("n"), *[f(n).alias(f"{m}{n}") for n in names for m, f in (("m", F.avg), ("c", F.count))]).first()
    if not stats["n"] or any(stats[f"c{n}"] != stats["n"] for n in names):
        raise ValueError("needs rows without NULL")
    means = np.array([stats[f"m{n}"] for n in names])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((d + 1, d + 1))
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(d + 1)]) - means
            out += x.T @ x
        yield pa.record_batch([pa.array(np.arange((d + 1) ** 2), pa.int32()), pa.array(out.ravel())], ["i", "v"])

    products = np.zeros((d + 1) ** 2)
    for r in data.mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        products[r["i"]] = r["v"]
    products = products.reshape(d + 1, d + 1)
    weights = np.linalg.pinv(products[:d, :d], rcond=RANK, hermitian=True) @ products[:d, d]
    return Linear(cols, weights, float(means[d] - means[:d] @ weights))
