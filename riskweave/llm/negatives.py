"""Hard negatives by inner product, searched in R-trees packed by sort-tile-recursive.

All rows are range-partitioned by their widest coordinate; every partition is a slab that one
task sorts and tiles by label and further coordinates into leaves with bounding boxes. The leaves are stored once.
Queries go in blocks of bounded size over all leaves: a task builds the upper levels over a run of
leaves, and a best-first queue visits boxes in the order of their upper bound. A box lies between two
inner products, one per end of each coordinate's interval; it is left out if that interval misses the
score windows, or if its upper end is strictly below the k-th best score so far.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.session import materialize, ship_package

#: Rows of a slab, which one task tiles; rows of a leaf; children of an inner node; leaves of one tree.
SLAB_ROWS, LEAF_ROWS, FANOUT, TREE_LEAVES = 16_384, 128, 16, 512
#: Query rows that are sent to all tasks at once.
BLOCK_ROWS = 4_096
_EXACT = 2.0**53


def quantised(rows: DataFrame, key: str, label: str, vector: str, scale: int) -> DataFrame:
    """Distinct ``id``, ``label``, ``x`` (floor of ``scale`` times each component, as a double) of the rows that take part.

    Rows with a NULL key, label or vector, or any NULL or non-finite component, take no part; repeated
    rows count once. Other columns are not carried, so their names cannot clash.
    """
    given = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    usable = given.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(
        F.forall("v", lambda c: F.coalesce(F.abs(c) < F.lit(math.inf), F.lit(False)) & ~F.isnan(c)))
    return usable.select("id", "label", F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))).alias("x")).distinct()


# --- index ------------------------------------------------------------------------------------------


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which add nothing to an inner product."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def str_order(x: np.ndarray, label: np.ndarray, ids: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Rows of each leaf: sorted by label and cut into slabs, each of these sorted by the next widest coordinate and cut again."""
    spread = x.astype(float).var(axis=0) if len(x) else np.zeros(x.shape[1])
    keys = [label, *[x[:, c] for c in np.argsort(-spread, kind="stable")]]
    leaves: list[np.ndarray] = []

    def tile(rows: np.ndarray, depth: int) -> None:
        tiles = math.ceil(len(rows) / leaf)
        rows = rows[np.lexsort((ids[rows], keys[depth][rows]))]
        if tiles <= 1 or depth == len(keys) - 1:
            leaves.extend(rows[a:a + leaf] for a in range(0, len(rows), leaf))
            return
        step = math.ceil(tiles / math.ceil(math.sqrt(tiles))) * leaf
        for a in range(0, len(rows), step):
            tile(rows[a:a + step], depth + 1)

    if len(x):
        tile(np.arange(len(x)), 0)
    return leaves


_LEAVES = "leaf int, ids binary, labels binary, x binary"


def build_index(points: DataFrame, slab_rows: int = SLAB_ROWS, leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, int]:
    """Stored leaves of all stored ``points`` (id, label, x) and the number of coordinates. Every row is in one leaf."""
    spark = points.sparkSession
    ship_package(spark)
    size = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    width = max(size["d"] or 0, 1)
    wide = points.select(F.posexplode("x").alias("c", "v")).groupBy("c").agg(F.variance("v").alias("s")).orderBy(F.desc("s"), "c").limit(1).collect()
    first = F.get("x", F.lit(wide[0]["c"] if wide else 0))
    slabs = max(math.ceil(size["n"] / slab_rows), min(spark.sparkContext.defaultParallelism, math.ceil(size["n"] / leaf_rows)), 1)
    # equal coordinates are told apart by a hash, so that copies of one vector spread over slabs
    ranged = points.withColumn("at", first).repartitionByRange(slabs, "at", F.xxhash64("id", "label"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        ids, label, lists = [table.column(n).combine_chunks() for n in ("id", "label", "x")]
        ids, label, x = ids.to_numpy(), label.to_numpy(), _matrix(lists, width)
        for number, rows in enumerate(str_order(x, label, ids, leaf_rows)):
            values = [pa.array([number], pa.int32()), *[pa.array([v[rows].tobytes()], pa.binary()) for v in (ids, label, x)]]
            yield pa.RecordBatch.from_arrays(values, ["leaf", "ids", "labels", "x"])

    packed = ranged.select("id", "label", "x").mapInArrow(pack, _LEAVES).withColumn("slab", F.spark_partition_id())
    return materialize(packed, "leaves"), width


# --- search -----------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Leaves and the boxes of all nodes, leaves first, each level after its children."""

    ids: list[np.ndarray]
    labels: list[np.ndarray]
    x: list[np.ndarray]
    low: np.ndarray
    high: np.ndarray
    label_low: np.ndarray
    label_high: np.ndarray
    children: list[tuple[int, int]]  # of inner nodes, in their order


def pack_tree(ids: list[np.ndarray], labels: list[np.ndarray], x: list[np.ndarray], fanout: int = FANOUT) -> Tree:
    low, high = [v.min(axis=0) for v in x], [v.max(axis=0) for v in x]
    label_low, label_high = [int(v.min()) for v in labels], [int(v.max()) for v in labels]
    children: list[tuple[int, int]] = []
    start, end = 0, len(x)
    while end - start > 1:
        for a in range(start, end, fanout):
            b = min(a + fanout, end)
            children.append((a, b))
            low.append(np.min(low[a:b], axis=0))
            high.append(np.max(high[a:b], axis=0))
            label_low.append(min(label_low[a:b]))
            label_high.append(max(label_high[a:b]))
        start, end = end, len(low)
    return Tree(ids, labels, x, np.array(low), np.array(high), np.array(label_low), np.array(label_high), children)


@dataclass
class Queries:
    """A block: vectors, and per query its windows (low, high, number) of scores that are wanted."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    windows: list[list[tuple[float, float, int]]]
    same_label: bool
    k: int


def exact_kind(*parts: np.ndarray) -> type:
    """Number type in which all inner products of rows of the two parts are exact."""
    a, b = ([float(np.abs(p).max()) if p.size else 0.0 for p in parts] + [0.0, 0.0])[:2]
    most = a * b * max(p.shape[1] for p in parts)
    if most >= 2.0**62:
        raise ArithmeticError("inner products do not fit in 64 bits")
    return np.float64 if most < _EXACT else np.int64


def search(tree: Tree, q: Queries) -> Iterator[tuple[int, int, int, int]]:
    """Rows (query number, window number, score, id): of this tree the ``k`` best of every window, by score, then smaller id."""
    leaves, n = len(tree.x), len(tree.low)
    kind = exact_kind(q.x, np.concatenate([tree.low, tree.high]))
    qx, low, high = q.x.astype(kind), tree.low.astype(kind), tree.high.astype(kind)
    up, down = np.maximum(qx, 0), np.minimum(qx, 0)
    upper, lower = up @ high.T + down @ low.T, up @ low.T + down @ high.T  # queries x nodes
    data = [v.astype(kind) for v in tree.x]
    pure = tree.label_low == tree.label_high
    for i in range(len(q.ids)):
        label = q.labels[i]
        # Open windows with their best rows, worst first; an equal score counts as worse with a larger id.
        wanted = [(a, b, number, []) for a, b, number in q.windows[i]]
        if q.same_label:
            usable = (tree.label_low <= label) & (label <= tree.label_high)
        else:
            usable = ~(pure & (tree.label_low == label))
        above, below = upper[i], lower[i]
        queue = [(-above[n - 1], n - 1)] if wanted and usable[n - 1] else []
        while queue:
            node = heapq.heappop(queue)[1]
            # A full window asks for its k-th score at least: an equal score may have a smaller id.
            ask = [(max(a, best[0][0]) if len(best) == q.k else a, b, best) for a, b, _, best in wanted]
            if above[node] < min(a for a, _, _ in ask):
                break
            ask = [(a, b, best) for a, b, best in ask if above[node] >= a and below[node] <= b]
            if not ask:
                continue
            if node >= leaves:
                for child in range(*tree.children[node - leaves]):
                    if usable[child]:
                        heapq.heappush(queue, (-above[child], child))
                continue
            score = data[node] @ qx[i]
            fits = (tree.labels[node] == label) == q.same_label
            if q.same_label:
                me = fits & (tree.ids[node] == q.ids[i])
                if me.any():
                    fits &= ~(me & (tree.x[node] == q.x[i]).all(axis=1))
            for a, b, best in ask:
                hit = np.flatnonzero(fits & (score >= a) & (score <= b))
                if len(hit) > q.k:
                    hit = hit[np.lexsort((tree.ids[node][hit], -score[hit]))[:q.k]]
                for h in hit:
                    heapq.heappush(best, (int(score[h]), -int(tree.ids[node][h])))
                    if len(best) > q.k:
                        heapq.heappop(best)
        for _, _, number, best in wanted:
            for value, minus in best:
                yield i, number, value, -minus


_FOUND = "query int, window int, score long, id long"


def _runs(batches: Iterator[pa.RecordBatch], width: int, leaves: int) -> Iterator[Tree]:
    """Trees over runs of at most ``leaves`` leaves of a task's part of the index."""
    ids, labels, x = [], [], []
    for batch in batches:
        for a, b, c in zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("ids", "labels", "x")]):
            ids.append(np.frombuffer(a, np.int64))
            labels.append(np.frombuffer(b, np.int64))
            x.append(np.frombuffer(c, np.int64).reshape(-1, width))
            if len(x) == leaves:
                yield pack_tree(ids, labels, x)
                ids, labels, x = [], [], []
    if x:
        yield pack_tree(ids, labels, x)


def best_rows(index: DataFrame, width: int, block: Queries) -> DataFrame:
    """``query``, ``window``, ``rank``, ``score``, ``id`` of the ``k`` best rows of all leaves for every window of a block."""
    shared = index.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_ROWS queries

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _runs(batches, width, TREE_LEAVES):
            found = list(zip(*search(tree, shared.value)))
            if found:
                types = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], ["query", "window", "score", "id"])

    found = index.select("ids", "labels", "x").mapInArrow(look, _FOUND)
    order = W.partitionBy("query", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= block.k)


_MINED = "anchor long, positive long, rank int, negative long, positive_score long, negative_score long"


def mine(
    points: DataFrame, anchors: Column, k: int = 5, low: int = 80, high: int = 100, block_rows: int = BLOCK_ROWS,
    slab_rows: int = SLAB_ROWS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``anchor``, ``positive``, ``rank``, ``negative``, ``positive_score``, ``negative_score``.

    ``anchors`` is a condition on ``points`` (id, label, x: distinct rows). An anchor's positives are its ``k`` best
    other rows of the same label; the negatives of each are the ``k`` best rows of other labels whose score is
    between ``low`` and ``high`` percent of the positive's. Ties go to the smaller id. Vectors of unequal
    length are compared over the coordinates both have; an empty vector scores 0. Anchors are searched
    in blocks of about ``block_rows``, so what the driver and the tasks hold of them is bounded.
    """
    spark = points.sparkSession
    points = materialize(points, "points")
    index, width = build_index(points, slab_rows, leaf_rows)
    chosen = materialize(points.where(anchors), "anchors")
    blocks = math.ceil(chosen.count() / block_rows)
    parts = []
    for number in range(blocks):
        mine_ = chosen.where(F.pmod(F.xxhash64("id", "label", "x"), F.lit(blocks)) == number).orderBy("id", "label", "x").toArrow()
        if not mine_.num_rows:
            continue
        column = lambda n, t=mine_: t.column(n).combine_chunks()
        ids, labels, x = column("id").to_numpy(), column("label").to_numpy(), _matrix(column("x"), width)
        anywhere = [[(-math.inf, math.inf, 0)] for _ in ids]
        positives = best_rows(index, width, Queries(ids, labels, x, anywhere, True, k)).orderBy("query", "rank").collect()  # k a query
        windows: list[list[tuple[int, int, int]]] = [[] for _ in ids]
        names: list[tuple[int, int, int, int, int]] = []
        for r in positives:
            a, b = -(-low * r["score"] // 100), high * r["score"] // 100  # whole scores between the two shares
            if a <= b:
                windows[r["query"]].append((a, b, r["rank"]))
                names.append((r["query"], r["rank"], int(ids[r["query"]]), r["id"], r["score"]))
        found = best_rows(index, width, Queries(ids, labels, x, windows, False, k))
        named = spark.createDataFrame(names, "query int, window int, anchor long, positive long, positive_score long")
        rows = found.join(F.broadcast(named), ["query", "window"])  # at most k rows a query
        parts.append(materialize(rows.select(
            "anchor", "positive", "rank", F.col("id").alias("negative"), "positive_score", F.col("score").alias("negative_score")), "negatives"))
    if not parts:
        return spark.createDataFrame([], _MINED)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionAll(more)
    return out
