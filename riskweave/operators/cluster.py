"""K-means with restarts, cluster labels and centroid tables.

All (k, restart) pairs are refined together: one pass over the points serves
every model that still moves. Inside a task Arrow batches go through one matrix
product; a task returns one row of sums per centroid, whatever its row count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.functions.columns import round_half_even
from riskweave.session import materialize, ship_package

# Candidates for starting centres: drawn in each pass over all points, and passes.
DRAWN = 40
DRAWS = 5
SEED = 42


@dataclass
class KMeansFit:
    k: int
    centers: np.ndarray  # k x d
    wcss: float
    passes: int


def as_points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as one array column ``x`` of doubles."""
    return df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))


def _inspect(points: DataFrame) -> tuple[np.ndarray, float]:
    """Mean and mean column variance of all points; broken points are an error. Two small jobs."""
    first = points.where("size(x) > 0").select(F.size("x").alias("d")).first()
    if first is None:
        raise ValueError("no points to cluster")
    d = first["d"]
    bad = F.col("x").isNull() | (F.size("x") != d) | F.exists("x", lambda v: v.isNull() | F.isnan(v))
    at = [F.get("x", F.lit(i)) for i in range(d)]
    row = points.agg(
        F.count_if(F.coalesce(bad, F.lit(True))).alias("bad"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)],
        *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(at)]).first()
    if row["bad"]:
        raise ValueError(f"{row['bad']} points are or hold NULL or NaN, or have another length than {d}")
    return np.array([row[f"m{i}"] for i in range(d)]), sum(row[f"v{i}"] for i in range(d)) / d


def weighted_points(points: DataFrame) -> DataFrame:
    """Distinct points ``x`` with their number ``w``.

    Copies are counted before the shuffle, so later passes handle a hot point once.
    """
    return points.groupBy("x").agg(F.count(F.lit(1)).alias("w"))


def _draw(points: DataFrame, chosen: np.ndarray, origin: np.ndarray, size: int, seed: int) -> np.ndarray:
    """``size`` distinct points, drawn in proportion to weight times squared distance to ``chosen``.

    Every point gets the key -log(u) / (w d^2) with u from a hash, and the smallest keys win
    (Efraimidis and Spirakis 2006): one pass, at most ``size`` rows from each task.
    """
    ship_package(points.sparkSession)

    @F.arrow_udf("double")
    def distance(x: pa.Array) -> pa.Array:
        at = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(origin)) - origin
        best = _distances(at, chosen).min(axis=1)
        # next to a chosen point the product is round-off; differences are exactly 0 for the point itself
        for i in np.flatnonzero(best <= 1e-7 * (at**2).sum(axis=1)):
            best[i] = ((at[i] - chosen) ** 2).sum(axis=1).min()
        return pa.array(best)

    u = (F.shiftrightunsigned(F.xxhash64("x", F.lit(seed)), 11) + 0.5) / F.lit(float(2**53))
    key = F.try_divide(-F.log(u), F.col("w") * F.col("d2"))  # NULL for points that are chosen already
    far = points.withColumn("d2", distance("x")).withColumn("key", key).where("key IS NOT NULL")
    rows = far.select("x", "key").orderBy("key", "x").limit(size).collect()
    return np.array([r["x"] for r in rows], dtype=float).reshape(-1, len(origin)) - origin


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] - 2.0 * x @ centers.T + (centers**2).sum(axis=1), 0.0)


def _candidates(points: DataFrame, origin: np.ndarray, seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates for centres and the number of points nearest to each (k-means||, Bahmani et al. 2012).

    All points take part in every draw and in the weights. What reaches the driver are at most
    ``DRAWS * size + 1`` points.
    """
    first = points.orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(1).collect()
    chosen = np.array([r["x"] for r in first], dtype=float) - origin
    for i in range(DRAWS):
        more = _draw(points, chosen, origin, size, seed + 1 + i)
        if not len(more):
            break
        chosen = np.vstack([chosen, more])
    counts, _, _ = _pass(points, [chosen], origin)
    return chosen, counts


def _plus_plus(sample: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Starting centres spread by weighted squared distance (Arthur and Vassilvitskii 2007)."""
    centers = [sample[rng.choice(len(sample), p=weight / weight.sum())]]
    nearest = ((sample - centers[0]) ** 2).sum(axis=1)
    while len(centers) < k:
        total = (weight * nearest).sum()
        pick = rng.choice(len(sample), p=weight * nearest / total) if total > 0 else rng.integers(len(sample))
        centers.append(sample[pick])
        nearest = np.minimum(nearest, ((sample - centers[-1]) ** 2).sum(axis=1))
    return np.array(centers)


def _refine(sample: np.ndarray, weight: np.ndarray, centers: np.ndarray, steps: int = 50) -> np.ndarray:
    """Recluster the weighted candidates, so that fewer passes over all points follow."""
    for _ in range(steps):
        near = _distances(sample, centers).argmin(axis=1)
        new = centers.copy()
        for j in range(len(centers)):
            if weight[near == j].sum() > 0:
                new[j] = np.average(sample[near == j], axis=0, weights=weight[near == j])
        if np.allclose(new, centers):
            break
        centers = new
    return centers


def _pass(points: DataFrame, centers: list[np.ndarray], origin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One assignment pass for several models, in coordinates relative to ``origin``.

    Returns per centroid the weight, the squared distances and the coordinate sums. Moving the
    origin into the data keeps the products exact enough wherever the points lie.
    """
    ship_package(points.sparkSession)
    d = len(origin)
    starts = np.concatenate([[0], np.cumsum([len(c) for c in centers])])
    m = int(starts[-1])
    stacked = points.sparkSession.sparkContext.broadcast(np.vstack(centers))

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = stacked.value
        out = np.zeros((m, d + 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - origin
            w = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            dist = c @ x.T  # a row per centroid, so that all that follows runs along the points
            dist *= -2.0
            dist += (x**2).sum(axis=1)
            dist += (c**2).sum(axis=1)[:, None]
            np.maximum(dist, 0.0, out=dist)
            member = np.empty((m, len(x)))
            for a, b in zip(starts[:-1], starts[1:]):
                least, near = dist[a].copy(), np.zeros(len(x), dtype=np.int32)
                for j in range(1, b - a):
                    near[dist[a + j] < least] = j
                    np.minimum(least, dist[a + j], out=least)
                for j in range(b - a):
                    np.multiply(near == j, w, out=member[a + j])
                out[a:b, 1] += member[a:b] @ least
            out[:, 0] += member.sum(axis=1)
            out[:, 2:] += member @ x
        arrays = [pa.array(np.arange(m, dtype=np.int32)), *[pa.array(out[:, j]) for j in range(d + 2)]]
        yield pa.RecordBatch.from_arrays(arrays, ["slot", *[f"s{j}" for j in range(d + 2)]])

    schema = "slot int, " + ", ".join(f"s{j} double" for j in range(d + 2))
    # One row per centroid comes back.
    totals = points.select("x", "w").mapInArrow(sums, schema).groupBy("slot").sum().toArrow()
    got = np.zeros((m, d + 2))
    slots = totals.column("slot").to_numpy()
    for j in range(d + 2):
        got[slots, j] = totals.column(f"sum(s{j})").to_numpy()
    stacked.destroy()
    return got[:, 0], got[:, 1], got[:, 2:]


def fit_many(
    points: DataFrame, ks: Sequence[int], restarts: int = 10, seed: int = SEED, max_iter: int = 300,
    tol: float = 1e-4, store: bool = True,
) -> dict[int, KMeansFit]:
    """Best of ``restarts`` k-means models for each k, over the array column ``x``.

    A model stops when its centres move by at most ``tol`` times the mean column
    variance (squared), or after ``max_iter`` passes. Emptied clusters keep their centre.
    ``store`` writes the points once, so that passes do not repeat the query before.
    """
    origin, variance = _inspect(points)
    points = weighted_points(points)
    if store:
        points = materialize(points, "points", spread=True)
    sample, weight = _candidates(points, origin, seed, max(DRAWN, 2 * max(ks)))
    models = [
        (k, _refine(sample, weight, _plus_plus(sample, weight, k, np.random.default_rng([seed, k, r]))))
        for k in ks for r in range(restarts)
    ]
    centers = [c for _, c in models]
    moving, passes = list(range(len(models))), [0] * len(models)
    for _ in range(max_iter):
        if not moving:
            break
        counts, _, sums = _pass(points, [centers[i] for i in moving], origin)
        still, at = [], 0
        for i in moving:
            k = len(centers[i])
            c, s = counts[at:at + k], sums[at:at + k]
            at += k
            new = np.where(c[:, None] > 0, s / np.maximum(c, 1.0)[:, None], centers[i])
            shift = float(((new - centers[i]) ** 2).sum())
            centers[i] = new
            passes[i] += 1
            if shift > tol * variance:
                still.append(i)
        moving = still
    _, cost, _ = _pass(points, centers, origin)
    best: dict[int, KMeansFit] = {}
    at = 0
    for (k, _), c, p in zip(models, centers, passes):
        wcss = float(cost[at:at + k].sum())
        at += k
        if k not in best or wcss < best[k].wcss:
            best[k] = KMeansFit(k, c + origin, wcss, p)
    return best


def lloyd(points: DataFrame, centers: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres, counts, squared distances) after ``steps`` passes from given centres.

    Counts and distances are those to the returned centres. An emptied cluster keeps its centre.
    """
    _inspect(points)
    stored = materialize(weighted_points(points), "points", spread=True)
    origin = np.asarray(centers, dtype=float).mean(axis=0)
    at = np.asarray(centers, dtype=float) - origin
    for _ in range(steps):
        counts, _, sums = _pass(stored, [at], origin)
        at = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1.0)[:, None], at)
    counts, cost, _ = _pass(stored, [at], origin)
    return at + origin, counts, cost


def assignment_table(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """Rows (cluster, row_count, wcss) of one assignment pass over the points."""
    _, counts, cost = lloyd(points, centers, 0)
    rows = [(i, int(n), float(c)) for i, (n, c) in enumerate(zip(counts, cost))]
    return points.sparkSession.createDataFrame(rows, "cluster int, row_count bigint, wcss double")


def elbow_table(spark: SparkSession, fits: Mapping[int, KMeansFit]) -> DataFrame:
    """Rows (k, wcss, ratio_to_first) of fitted models in ascending k."""
    first = fits[min(fits)].wcss
    rows = [(k, fits[k].wcss, fits[k].wcss / first if first else None) for k in sorted(fits)]
    return spark.createDataFrame(rows, "k int, wcss double, ratio_to_first double")


def elbow(points: DataFrame, ks: Sequence[int] = range(2, 9), restarts: int = 10, seed: int = SEED) -> DataFrame:
    """Within-cluster sum of squares of the best model for each k."""
    return elbow_table(points.sparkSession, fit_many(points, list(ks), restarts, seed))


def fit_kmeans(points: DataFrame, k: int = 3, restarts: int = 10, seed: int = SEED) -> KMeansFit:
    return fit_many(points, [k], restarts, seed)[k]


def squared_distance(x: Column | Sequence[str], center: Sequence[float]) -> Column:
    """Squared distance to a fixed centre, from an array column or from plain columns."""
    if isinstance(x, Column):
        diffs = F.zip_with(x, F.array(*[F.lit(float(v)) for v in center]), lambda a, b: (a - b) * (a - b))
        return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)
    terms = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(x, center)]
    return sum(terms[1:], terms[0])


def assign(df: DataFrame, x: Column | Sequence[str], centers: np.ndarray) -> DataFrame:
    """Add ``cluster``, the index of the nearest centre, and ``sq_dist``; ties go to the lower index.

    An array column goes through Arrow in batches; NULL, or a wrong length, has no cluster.
    """
    if isinstance(x, Column):
        centers = np.asarray(centers, dtype=float)
        d = centers.shape[1]

        @F.arrow_udf("struct<cluster int, sq_dist double>")
        def near(points: pa.Array) -> pa.Array:
            good = points.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == d
            m = points.filter(pa.array(good)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)  # NULLs become NaN
            best, least = np.zeros(len(m), dtype=np.int32), np.full(len(m), np.inf)
            for i, c in enumerate(centers):
                dist = ((m - c) ** 2).sum(axis=1)
                closer = dist < least
                best[closer], least[closer] = i, dist[closer]
            cluster, sq_dist = np.zeros(len(points), dtype=np.int32), np.zeros(len(points))
            cluster[good], sq_dist[good] = best, least
            good[good] = ~np.isnan(m).any(axis=1)
            return pa.StructArray.from_arrays([pa.array(cluster, mask=~good), pa.array(sq_dist, mask=~good)], ["cluster", "sq_dist"])

        placed = df.withColumn("__near", near(x))
        return placed.select(*df.columns, "__near.cluster", "__near.sq_dist")
    nearest = F.array_min(F.array(*[
        F.struct(squared_distance(x, c).alias("sq_dist"), F.lit(i).alias("cluster")) for i, c in enumerate(centers)
    ]))
    return df.withColumn("__near", nearest).select(*df.columns, "__near.cluster", "__near.sq_dist")


def cluster_rates(df: DataFrame, cluster: str, outcome: str) -> DataFrame:
    """Rows (cluster, row_count, outcome_rate), one per cluster; rows without one are left out."""
    return df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count("*").alias("row_count"), F.avg(outcome).alias("outcome_rate"))


def rank_labels(profile: DataFrame, cluster: str, labels: Sequence[str]) -> DataFrame:
    """Rows (cluster, risk_rank, risk_label): labels in ascending order of the outcome rate.

    The lowest rate has the first label and the highest the last; with more clusters than labels
    neighbouring ranks share one, with fewer some stay unused.
    """
    rank = F.row_number().over(W.orderBy("outcome_rate", cluster))  # one row per cluster
    ranked = profile.select(cluster, rank.alias("risk_rank"), F.count(F.lit(1)).over(W.partitionBy(F.lit(0))).alias("n"))
    place = F.floor((F.col("risk_rank") - 1) * (len(labels) - 1) / F.greatest(F.col("n") - 1, F.lit(1)) + 0.5)
    names = F.array(*[F.lit(v) for v in labels])
    return ranked.select(cluster, "risk_rank", F.get(names, place.cast("int")).alias("risk_label"))


def label_clusters(df: DataFrame, cluster: str, outcome: str, labels: Sequence[str]) -> DataFrame:
    """Add ``risk_label``: clusters ranked by their outcome rate."""
    ranked = rank_labels(cluster_rates(df, cluster, outcome), cluster, labels)
    return df.join(ranked.select(cluster, "risk_label"), cluster, "left")


def label_profile(labelled: DataFrame, outcome: str, labels: Sequence[str], digits: int = 3) -> DataFrame:
    """Rows (ord, risk_label, row_count, outcome_rate, outcome_percent) in label order."""
    stats = labelled.groupBy("risk_label").agg(F.count("*").alias("n"), F.avg(outcome).alias("rate"))
    order = labelled.sparkSession.createDataFrame(list(enumerate(labels)), "ord int, risk_label string")
    return order.join(stats, "risk_label", "left").select(
        "ord", "risk_label", F.coalesce("n", F.lit(0)).alias("row_count"),
        round_half_even("rate", digits).alias("outcome_rate"), (F.col("rate") * 100).alias("outcome_percent"),
    )


def centroid_table(df: DataFrame, fit: KMeansFit, names: Sequence[str], ranked: DataFrame | None = None) -> DataFrame:
    """Rows (cluster, feature, value); with ``ranked`` also (risk_rank, risk_label)."""
    rows = [(i, n, float(v)) for i, c in enumerate(fit.centers) for n, v in zip(names, c, strict=True)]
    table = df.sparkSession.createDataFrame(rows, "cluster int, feature string, value double")
    return table if ranked is None else table.join(F.broadcast(ranked), "cluster")
