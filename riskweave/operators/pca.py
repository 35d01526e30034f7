"""Principal components of numeric columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import ship_package

SEED = 42
#: Directions followed at once, passes over the rows at most, and the residual (as a share of the whole variance) that counts as none.
BLOCK, PASSES, TOLERANCE = 64, 60, 1e-12


def _block(df: DataFrame, cols: Sequence[str], means: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Centred cross products with the block: X'(X q), d x l numbers summed up over tasks."""
    d, l = q.shape
    ship_package(df.sparkSession)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((d, l))
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(d)]) - means
            out += x.T @ (x @ q)
        yield pa.record_batch([pa.array(np.arange(d * l), pa.int32()), pa.array(out.ravel())], ["i", "v"])

    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    rows = doubles.mapInArrow(multiply, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(d * l)
    for r in rows:
        out[r["i"]] = r["v"]
    return out.reshape(d, l)


def fit_pca(df: DataFrame, cols: Sequence[str], k: int = 2, seed: int = SEED, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(loadings k x d, means, explained variance ratios), by block power iteration from a random start.

    A pass multiplies the centred rows with a block of directions and sums up d x ``block`` numbers; up to ``block`` columns
    one pass is exact, more take passes until the components' residual is round-off or ``PASSES`` are done. No d x d matrix
    is made for wide tables. Each component's largest loading is made positive. NULLs are an error: impute them first.
    """
    d = len(cols)
    if not 0 < k <= d:
        raise ValueError(f"{k} components of {d} columns")
    stats = df.agg(
        F.count(F.lit(1)).alias("n"), *[f(F.col(f"`{c}`").cast("double")).alias(f"{m}{i}") for i, c in enumerate(cols)
                                        for m, f in (("m", F.avg), ("v", F.var_samp), ("c", F.count))]).first()
    if any(stats[f"c{i}"] != stats["n"] for i in range(d)) or stats["n"] < 2:
        raise ValueError("needs two rows at least, and no NULL")
    means, trace = np.array([stats[f"m{i}"] for i in range(d)]), sum(stats[f"v{i}"] for i in range(d))
    width = min(d, max(block, k + 8))
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))[0]
    for _ in range(PASSES):
        z = _block(df, cols, means, q) / (stats["n"] - 1)
        values, inner = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
        values, inner = values[::-1][:k], inner[:, ::-1][:, :k]
        loadings = (q @ inner).T
        residual = np.abs(z @ inner - loadings.T * values).max()
        if residual <= TOLERANCE * max(trace, 1e-300):
            break
        q = np.linalg.qr(z)[0]
    largest = np.abs(loadings).argmax(axis=1)
    loadings = loadings * np.where(loadings[np.arange(k), largest] < 0, -1.0, 1.0)[:, None]
    return loadings, means, [float(v / trace) if trace > 0 else 0.0 for v in values]


def apply_pca(df: DataFrame, cols: Sequence[str], loadings: np.ndarray, means: np.ndarray) -> DataFrame:
    """Add ``pc1``, ``pc2``, ... as sums of centred columns times loadings."""
    def component(weights: np.ndarray) -> Column:
        terms = [(F.col(c) - F.lit(float(m))) * F.lit(float(w)) for c, m, w in zip(cols, means, weights)]
        return sum(terms[1:], terms[0])

    return df.withColumns({f"pc{i + 1}": component(w) for i, w in enumerate(loadings)})


def pca_2d(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with pc1 and pc2, rows (component, explained_ratio))."""
    loadings, means, ratios = fit_pca(df, cols, 2)
    variance = df.sparkSession.createDataFrame(
        [(f"pc{i + 1}", r) for i, r in enumerate(ratios)], "component string, explained_ratio double"
    )
    return apply_pca(df, cols, loadings, means), variance
