"""Isolation forest (Liu, Ting and Zhou 2008) for multivariate outliers.

Sampling, scoring and the score quantile run over the whole table in Spark. Only
the small per-tree samples are handed to a Python function that grows one tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.forest import draw, draw64, key_of
from riskweave.operators.quantiles import exact_quantiles
from riskweave.session import materialize, ship_package

_NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, path double"


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


@dataclass
class IsolationForest:
    columns: list[str]
    nodes: pd.DataFrame  # one row per node of all trees
    trees: int
    sample_size: int


def _smallest(parts: list[tuple[np.ndarray, ...]], psi: int) -> tuple[np.ndarray, ...]:
    """Of (draws, keys, values) the ``psi`` rows of smallest draw, then key."""
    z, k, x = (np.concatenate(c) for c in zip(*parts))
    if len(z) > psi:
        z, k, x = (c[np.lexsort((k, z))[:psi]] for c in (z, k, x))
    return z, k, x


def _bottom(rows: DataFrame, d: int, trees: int, psi: int, seed: int, limit: int) -> DataFrame:
    """``tree``, ``z``, ``k`` and values of the rows with the ``psi`` smallest draws below ``limit`` in each tree.

    Every task keeps ``psi`` rows a tree, and of those the smallest are kept where a tree's rows meet.
    """
    names = ["tree", "z", "k", *[f"x{i}" for i in range(d)]]

    def given(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for tree, parts in held.items():
            z, k, x = _smallest(parts, psi)
            columns = [pa.array(np.full(len(z), tree, np.int32)), pa.array(z.view(np.int64)), pa.array(k.view(np.int64)), *[pa.array(x[:, i]) for i in range(d)]]
            yield pa.RecordBatch.from_arrays(columns, names)

    def take(held: dict[int, list], tree: int, part: tuple) -> None:
        own = held.setdefault(tree, [])
        own.append(part)
        if sum(len(z) for z, _, _ in own) > 4 * psi:
            held[tree] = [_smallest(own, psi)]

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            k = b.column(0).to_numpy().view(np.uint64)
            x = np.column_stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(d)])
            for tree in range(trees):
                z = draw64(k, seed * 1000 + tree + 1)
                near = np.flatnonzero(z <= np.uint64(limit))
                if len(near):
                    take(held, tree, (z[near], k[near], x[near]))
        yield from given(held)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            tree, z, k, *x = [b.column(i).to_numpy(zero_copy_only=False) for i in range(d + 3)]
            x = np.column_stack(x)
            for t in np.unique(tree):
                own = tree == t
                take(held, int(t), (z[own].view(np.uint64), k[own].view(np.uint64), x[own]))
        yield from given(held)

    schema = "tree int, z long, k long, " + ", ".join(f"x{i} double" for i in range(d))
    tasks = min(trees, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.mapInArrow(drawn, schema).repartition(tasks, "tree").mapInArrow(merged, schema)


def tree_samples(df: DataFrame, cols: Sequence[str], key: str, trees: int, psi: int, seed: int, rows: int) -> DataFrame:
    """Stored rows (tree, z, k, x0, x1, ...): for each tree the ``psi`` rows of smallest draw from row key and tree.

    Only draws that some eight times ``psi`` rows have are looked at; should a tree not fill up with those, the limit is raised.
    """
    ship_package(df.sparkSession)
    slim = df.select(key_of(df, key).alias("k"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    share = 8 * psi / max(rows, 1)
    while True:
        limit = min(int(share * 2**64), 2**64 - 1)
        found = materialize(_bottom(slim, len(cols), trees, psi, seed, limit), "samples")
        if limit == 2**64 - 1 or found.count() == trees * psi:
            return found
        share *= 8


def grow_tree(tree: int, data: np.ndarray, depth: int, seed: int) -> list[tuple]:
    """Nodes of one isolation tree. A node's column, among those that vary, and its cut between the column's extremes are
    drawn from the tree and the node's place (the root is 1, its children 2 and 3)."""
    nodes: list[list] = []
    todo = [(data, 0, -1, 0, 1)]
    while todo:
        rows, level, parent, side, place = todo.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][4 + side] = me
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if level >= depth or len(rows) <= 1 or not len(usable):
            nodes.append([tree, me, -1, 0.0, me, me, level + average_path(len(rows))])
            continue
        which, where = draw(np.array([place << 16, (place << 16) + 1]), seed * 1000 + tree + 1)
        col = int(usable[int(which) % len(usable)])
        cut = float(low[col] + (high[col] - low[col]) * (float(where) / 2**32))
        if cut >= high[col]:  # rounding may reach the upper end, which must go right
            cut = float(low[col])
        nodes.append([tree, me, col, cut, me, me, 0.0])
        goes_left = rows[:, col] <= cut
        todo += [(rows[~goes_left], level + 1, me, 1, 2 * place + 1), (rows[goes_left], level + 1, me, 0, 2 * place)]
    return [tuple(n) for n in nodes]


def fit_iforest(
    df: DataFrame, cols: Sequence[str], key: str, trees: int = 100, psi: int = 256, seed: int = 42, max_depth: int | None = None,
) -> IsolationForest:
    """Grow ``trees`` trees on ``min(psi, rows)`` rows each, by default to the depth at which that many rows are told apart.
    ``key`` must tell rows apart."""
    cols = list(cols)
    rows = df.count()
    if not rows:
        raise ValueError("no rows to fit")
    size = min(psi, rows)
    depth = max_depth or max(1, math.ceil(math.log2(max(size, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            grow_tree(int(pdf["tree"].iloc[0]), pdf[[f"x{i}" for i in range(len(cols))]].to_numpy(float), depth, seed),
            columns=["tree", "node", "feature", "split", "left", "right", "path"],
        )

    sample = tree_samples(df, cols, key, trees, size, seed, rows)
    # At most trees * (2 * psi - 1) nodes in all, whatever the table's size.
    nodes = sample.groupBy("tree").applyInPandas(grow, _NODE_SCHEMA).toPandas()
    return IsolationForest(cols, nodes.sort_values(["tree", "node"], ignore_index=True), trees, size)


def score_iforest(df: DataFrame, forest: IsolationForest, name: str = "anomaly") -> DataFrame:
    """Add the anomaly score in (0, 1); higher is more anomalous."""
    nodes = forest.nodes
    sizes = nodes.groupby("tree").size()
    root = sizes.cumsum().shift(fill_value=0)
    base = nodes["tree"].map(root).to_numpy()
    packed = (
        nodes["feature"].to_numpy(np.int32), nodes["split"].to_numpy(float),
        (nodes["left"].to_numpy() + base).astype(np.int32), (nodes["right"].to_numpy() + base).astype(np.int32),
        nodes["path"].to_numpy(float), root.to_numpy(np.int32),
    )
    shared = df.sparkSession.sparkContext.broadcast(packed)
    levels = max(1, math.ceil(math.log2(max(forest.sample_size, 2))))
    scale = average_path(forest.sample_size) or 1.0

    @F.pandas_udf("double")
    def anomaly(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        feature, cut, left, right, path, roots = shared.value
        for part in parts:
            x = part.to_numpy(float)
            at = np.broadcast_to(roots, (len(x), len(roots))).copy()
            row = np.arange(len(x))[:, None]
            for _ in range(levels):
                col = feature[at]
                leaf = col < 0
                value = x[row, np.where(leaf, 0, col)]
                # A leaf points to itself on both sides.
                at = np.where(value <= cut[at], left[at], right[at])
            yield pd.Series(np.exp2(-path[at].mean(axis=1) / scale))

    return df.withColumn(name, anomaly(F.struct(*[F.col(c).cast("double").alias(c) for c in forest.columns])))


def outlier_threshold(scored: DataFrame, score: str = "anomaly", contamination: float = 0.05) -> float:
    """Score that ``contamination`` of the rows exceed, exact."""
    return exact_quantiles(scored, [score], [1.0 - contamination])[score][0]


def mark_outliers(
    df: DataFrame, cols: Sequence[str], key: str, contamination: float = 0.05, trees: int = 100, psi: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Add ``anomaly`` and ``is_inlier``; rows tied with the threshold are inliers.

    The scored table is stored once, because the threshold needs several passes
    over the score alone and scoring is the costly step.
    """
    forest = fit_iforest(df, cols, key, trees, psi, seed)
    scored = materialize(score_iforest(df, forest), "anomaly")
    return scored.withColumn("is_inlier", F.col("anomaly") <= F.lit(outlier_threshold(scored, "anomaly", contamination)))


def drop_outliers(marked: DataFrame) -> DataFrame:
    """Keep the inliers."""
    return marked.where("is_inlier").drop("anomaly", "is_inlier")
