"""Decision trees and random forests grown from histograms, all trees at once.

Features become small codes once, by cuts near their quantiles. A pass over the coded rows counts
labels per (tree, node, feature, code) for all open nodes of all trees; the counts add up across tasks, and
where they meet each node's best split is chosen. A node of few rows is not passed over again: its rows go to one task, which
grows the rest of that branch, so a hundred trees of any depth take a few passes and one exchange.

A row's weight in a tree is a Poisson number drawn from a hash of the row's key and the tree, and the features
a node may use are drawn from a hash of the tree and the node. A forest therefore depends on the rows and the seed
alone, not on partitions, files or cores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import materialize, ship_package

SEED = 42
#: Cells per column in which values are counted before cuts are chosen, and rounds of refining crowded cells.
CELLS, CELL_ROUNDS = 4096, 4
#: Ranges in which one pass counts cells.
RANGES = 512
#: Weighted rows up to which a branch is grown in one task, and levels such a branch has at least; others cost less in the passes.
LOCAL_ROWS, LOCAL_LEVELS = 16_384, 3
#: Bytes of codes a task looks at together.
CHUNK_BYTES = 2 << 20
#: Features counted of a node beyond those it may use, since some do not differ among its rows.
SPARE = 2
#: Bytes of counts a task holds in one pass; more open nodes take more passes.
HISTOGRAM_BYTES = 96 << 20
#: Bytes of counts that leave a task in one batch.
COUNT_BYTES = 1 << 20
#: Bytes of rows a task holds before it passes them on to their branch.
BRANCH_BYTES = 64 << 20
#: Nodes of a forest that is still brought together (some 40 bytes each).
MAX_NODES = 10_000_000

# Multipliers of the draws; the SQL that regrows trees has the same.
KEY_FACTOR, TREE_FACTOR, MIX_FACTOR = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
#: Poisson(1): the 32-bit numbers from which a row counts once, twice and so on.
POISSON = [math.floor(sum(math.exp(-1) / math.factorial(j) for j in range(i + 1)) * 2**32) for i in range(12)]


# --- draws ------------------------------------------------------------------------------------------


def draw64(a: np.ndarray, b: int) -> np.ndarray:
    """64-bit numbers drawn from 64-bit numbers ``a`` and a whole number ``b``."""
    z = a.astype(np.uint64) * np.uint64(KEY_FACTOR)
    z += np.uint64(b * TREE_FACTOR % 2**64)
    for _ in range(2):
        z ^= z >> np.uint64(32)
        z *= np.uint64(MIX_FACTOR)
    return z


def draw(a: np.ndarray, b: int) -> np.ndarray:
    """The upper 32 bits of :func:`draw64`."""
    return draw64(a, b) >> np.uint64(32)


def key_of(df: DataFrame, key: str) -> Column:
    """64-bit number of a row key: whole numbers as they are (NULL as 0), other keys by their hash."""
    if isinstance(df.schema[key].dataType, T.IntegralType):
        return F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long"))
    return F.xxhash64(key)


def bag(keys: np.ndarray, tree: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows in a tree's bag, and how often each of them is in it."""
    drawn = draw(keys, seed * 1000 + tree + 1)
    rows = np.flatnonzero(drawn >= POISSON[0])
    drawn = drawn[rows]
    w = np.ones(len(rows), dtype=np.int64)
    more = np.flatnonzero(drawn >= POISSON[1])
    for least in POISSON[2:]:
        if not len(more):
            break
        w[more] += 1
        more = more[drawn[more] >= least]
    w[more] += 1
    return rows, w


def bag_weights(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's bag."""
    w = np.zeros(len(keys), dtype=np.int64)
    rows, often = bag(keys, tree, seed)
    w[rows] = often
    return w


def feature_order(tree: int, node: int, features: int, seed: int) -> np.ndarray:
    """Features in the order in which a node may use them."""
    at = np.arange(features, dtype=np.uint64) + np.uint64((node << 16) % 2**64)
    return np.argsort(draw(at, seed * 1000 + tree + 1), kind="stable")


# --- cuts and codes ---------------------------------------------------------------------------------


def find_cuts(df: DataFrame, cols: Sequence[str], bins: int = 64, cells: int = CELLS, rounds: int = CELL_ROUNDS) -> list[np.ndarray]:
    """Per column at most ``bins - 1`` cuts, each a value of the column: code 0 is up to the first cut, and so on.

    Rows are counted in equal cells between the extremes. A cell of more than two codes' rows that
    holds several values is counted again in cells of its own, up to ``rounds`` times. A cut is the largest
    value of the cell in which a code's share of the rows is reached.
    """
    if not 2 <= bins <= 256:
        raise ValueError("codes are bytes")
    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    ends = x.agg(*[f(f"x{i}").alias(f"{f.__name__}{i}") for i in range(len(cols)) for f in (F.min, F.max)]).first()
    # a column without a value, or with a NaN (the largest value), has no cuts
    open_ = [(i, ends[f"min{i}"], ends[f"max{i}"]) for i in range(len(cols)) if ends[f"min{i}"] is not None and ends[f"max{i}"] == ends[f"max{i}"]]
    found: list[list[tuple[float, float, int]]] = [[] for _ in cols]  # per column (least, largest, rows) of disjoint cells
    total = [0] * len(cols)
    for step in range(rounds):
        if not open_:
            break
        counted = [(a + r["g"], r) for a in range(0, len(open_), RANGES) for r in _count_cells(x, open_[a:a + RANGES], cells)]
        if step == 0:
            for g, r in counted:
                total[open_[g][0]] += r["n"]
        again = []
        for g, r in counted:
            i = open_[g][0]
            if r["least"] < r["most"] and r["n"] * bins > 2 * total[i] and step + 1 < rounds:
                again.append((i, r["least"], r["most"]))
            else:
                found[i].append((r["least"], r["most"], r["n"]))
        open_ = again
    out = []
    for own, n in zip(found, total):
        own.sort()
        cuts, upto, code = [], 0, 1
        for _, most, rows in own[:-1]:
            upto += rows
            if upto * bins >= code * n:
                cuts.append(most)
                code = upto * bins // n + 1
        out.append(np.array(cuts, dtype=float))
    return out


def _count_cells(x: DataFrame, ranges: list[tuple[int, float, float]], cells: int) -> list[Row]:
    """Rows (g, cell, n, least, most) of the cells that have rows, for ranges (column, low, high), from one pass."""
    ship_package(x.sparkSession)
    places = sorted({i for i, _, _ in ranges})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(ranges), cells), np.int64)
        least, most = np.full(n.shape, np.inf), np.full(n.shape, -np.inf)
        for part in _chunks(batches, 8 * len(places)):
            for j, i in enumerate(places):
                v = part.column(j).to_numpy()
                v = np.sort(v[v == v])  # NULLs come as NaN
                for g, (own, low, high) in enumerate(ranges):
                    if own != i:
                        continue
                    inside = v[np.searchsorted(v, low, "left"):np.searchsorted(v, high, "right")]
                    if not len(inside):
                        continue
                    cell = np.zeros(len(inside), np.int64)
                    if high > low:
                        with np.errstate(all="ignore"):
                            at = np.floor((inside - low) / (high - low) * cells)
                        cell = np.minimum(np.where(at == at, at, 0.0), cells - 1).astype(np.int64)
                    first = np.flatnonzero(np.diff(cell, prepend=-1))
                    last = np.append(first[1:], len(cell)) - 1
                    to = cell[first]
                    n[g, to] += last - first + 1
                    least[g, to] = np.minimum(least[g, to], inside[first])
                    most[g, to] = np.maximum(most[g, to], inside[last])
        g, cell = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(g, pa.int32()), pa.array(cell, pa.int64()), *[pa.array(v[g, cell]) for v in (n, least, most)]], ["g", "cell", "n", "least", "most"])

    counted = x.select(*[f"x{i}" for i in places]).mapInArrow(count, "g int, cell long, n long, least double, most double")
    return counted.groupBy("g", "cell").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).collect()  # ranges x cells at most


def coded(columns: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Codes, rows x columns: how many cuts are below the value."""
    out = np.empty((len(columns[0]), len(cuts)), dtype=np.uint8)
    for i, (x, own) in enumerate(zip(columns, cuts)):
        out[:, i] = np.searchsorted(own, x, side="left")
    return out


def encode(df: DataFrame, cols: Sequence[str], cuts: list[np.ndarray], label: str, key: str) -> DataFrame:
    """Stored ``k`` (64-bit key), ``y`` and ``codes`` (one byte per column) of every row."""
    ship_package(df.sparkSession)
    d = len(cols)
    rows = df.select(key_of(df, key).alias("k"), F.col(label).cast("int").alias("y"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [b.column(i + 2).to_numpy(zero_copy_only=False) for i in range(d)]
            codes = coded(values, cuts) if d else np.empty((b.num_rows, 0), np.uint8)
            ends = pa.py_buffer(np.arange(0, (b.num_rows + 1) * d, max(d, 1), dtype=np.int32)[:b.num_rows + 1])
            binary = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, ends, pa.py_buffer(np.ascontiguousarray(codes))])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), binary], ["k", "y", "codes"])

    return materialize(rows.mapInArrow(pack, "k long, y int, codes binary"), "codes", spread=True)


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Batches put together to some ``CHUNK_BYTES`` of ``width`` bytes a row."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows * width >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _rows_of(part: pa.Table, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, labels and codes (row after row) of a part of the encoded rows."""
    if part.column(1).null_count:
        raise ValueError("labels must not be NULL")
    flat = np.concatenate([np.frombuffer(c.buffers()[2], np.uint8)[c.offset * d:(c.offset + len(c)) * d] for c in part.column(2).chunks])
    return part.column(0).to_numpy().view(np.uint64), part.column(1).to_numpy().astype(np.int64), flat


# --- splits -----------------------------------------------------------------------------------------


@dataclass
class Layout:
    """How many codes each feature has, and how many features a node may use."""

    sizes: np.ndarray  # codes per feature
    usable: int
    max_depth: int
    seed: int


def orders(nodes: Sequence[tuple[int, int]], lay: Layout) -> np.ndarray:
    """Nodes x features: the features in the order in which each node may use them."""
    d = len(lay.sizes)
    out = np.tile(np.arange(d), (len(nodes), 1))
    if lay.usable < d:
        own = np.array([t for t, _ in nodes])
        at = np.arange(d, dtype=np.uint64) + np.array([(n << 16) % 2**64 for _, n in nodes], dtype=np.uint64)[:, None]
        for t in np.unique(own):  # as in feature_order
            out[own == t] = np.argsort(draw(at[own == t], lay.seed * 1000 + int(t) + 1), axis=1, kind="stable")
    return out


#: In place of a split's feature: a leaf, or a node of which too few of the features counted differ.
LEAF, UNDECIDED = -1, -2


def best_split(counts: np.ndarray, features: np.ndarray, node: int, whole: bool, lay: Layout) -> tuple[int, int, np.ndarray, int]:
    """(feature, code, counts of the left side, sides with one code of that feature) with the lowest gini impurity.

    ``counts`` are features x codes x 2 labels, in the order in which the node may use the features; ``whole`` says that all others
    do not differ. Of those that differ among the node's rows the first ``usable`` are looked at. Ties go to the
    feature, then the code, that comes first. The sides are 1 for left plus 2 for right.
    """
    n = counts[0].sum(axis=0)
    if node.bit_length() > lay.max_depth or n.min() == 0:
        return LEAF, 0, np.zeros(2), 0
    present = counts.any(axis=2)
    differs = np.flatnonzero(present.sum(axis=1) > 1)[:lay.usable]
    if len(differs) < lay.usable and not whole:
        return UNDECIDED, 0, np.zeros(2), 0
    if not len(differs):
        return LEAF, 0, np.zeros(2), 0
    used = differs[np.argsort(features[differs])]
    left = counts[used].cumsum(axis=1)
    right = n - left
    nl, nr = left.sum(axis=2), right.sum(axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        pure = (left[..., 0] * left[..., 0] + left[..., 1] * left[..., 1]) / nl + (right[..., 0] * right[..., 0] + right[..., 1] * right[..., 1]) / nr
    i, code = divmod(int(np.argmax(np.where((nl > 0) & (nr > 0), pure, -1.0))), counts.shape[1])
    own = present[used[i]]
    return int(features[used[i]]), code, left[i, code], int(own[:code + 1].sum() == 1) + 2 * int(own[code + 1:].sum() == 1)


def grow_branch(codes: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, root: int, lay: Layout) -> Iterator[tuple]:
    """Nodes (tree, node, feature, code, n0, n1) of a branch whose rows are all here, as :func:`best_split` would choose them.

    Only the features a node may use are counted.
    """
    codes_of, every = int(lay.sizes.max()), np.arange(len(lay.sizes))
    whole = np.bincount(y, w, 2)
    todo = [(np.arange(len(y)), root, int(whole[0]), int(whole[1]))]
    while todo:
        rows, node, n0, n1 = todo.pop()
        chosen = every[:0]
        if n0 and n1 and node.bit_length() <= lay.max_depth:
            part = codes[rows]
            differs = part.min(axis=0) != part.max(axis=0)
            order = feature_order(tree, node, len(every), lay.seed) if lay.usable < len(every) else every
            chosen = np.sort(order[differs[order]][:lay.usable])
        if not len(chosen):
            yield tree, node, -1, 0, n0, n1
            continue
        used, weight = part[:, chosen], w[rows]
        at = (used + np.arange(len(chosen)) * codes_of).ravel()
        size = len(chosen) * codes_of
        all_ = np.bincount(at, np.repeat(weight, len(chosen)), size).reshape(len(chosen), codes_of).cumsum(axis=1)
        l1 = np.bincount(at, np.repeat(weight * y[rows], len(chosen)), size).reshape(len(chosen), codes_of).cumsum(axis=1)
        l0 = all_ - l1
        r0, r1, right = n0 - l0, n1 - l1, n0 + n1 - all_
        valid = (all_ > 0) & (right > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            pure = (l0 * l0 + l1 * l1) / all_ + (r0 * r0 + r1 * r1) / right
        best = int(np.argmax(np.where(valid, pure, -1.0)))
        i, code = divmod(best, codes_of)
        yield tree, node, int(chosen[i]), code, n0, n1
        goes_left = used[:, i] <= code
        a, b = int(l0[i, code]), int(l1[i, code])
        for child, inside, c0, c1 in ((2 * node + 1, ~goes_left, n0 - a, n1 - b), (2 * node, goes_left, a, b)):
            if c0 and c1:
                todo.append((rows[inside], child, c0, c1))
            else:
                yield tree, child, -1, 0, c0, c1


# --- growing ----------------------------------------------------------------------------------------

_NODE = "tree int, node long, feature int, code int, n0 long, n1 long"
_NODE_TYPES = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
_NODE_NAMES = ["tree", "node", "feature", "code", "n0", "n1"]


def _node_batches(rows: Iterator[tuple], size: int = 50_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _NODE_TYPES)], _NODE_NAMES)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _NODE_TYPES)], _NODE_NAMES)


@dataclass
class Paths:
    """The nodes so far, as arrays: where a row of each tree goes, and the slot of the open node it ends in (-1: none).

    A node without a split sends every row to itself: no code is above 255.
    """

    roots: np.ndarray
    levels: np.ndarray  # per tree
    feature: np.ndarray
    code: np.ndarray
    left: np.ndarray
    slot: np.ndarray

    def slots(self, tree: int, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Slots of the rows whose codes begin at ``start``."""
        return self.slot.take(_walk(flat, start, int(self.roots[tree]), int(self.levels[tree]), self.feature, self.code, self.left))


def _walk(flat: np.ndarray, start: np.ndarray, root: int, levels: int, feature: np.ndarray, code: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The node in which each row ends; rows are codes one after the other, from ``start`` on."""
    at = np.full(len(start), root)
    for _ in range(levels):
        right = flat.take(start + feature.take(at)) > code.take(at)
        at = left.take(at)
        at += right
    return at


def _paths(trees: int, splits: dict[tuple[int, int], tuple[int, int]], open_: Sequence[tuple[int, int]]) -> Paths:
    slots = {k: i for i, k in enumerate(open_)}
    of = {t for t, _ in open_}
    keys = sorted({(t, 1) for t in range(trees)} | {(t, 2 * n + s) for t, n in splits for s in (0, 1) if t in of})
    place = {k: i for i, k in enumerate(keys)}
    split = [splits.get(k, (0, 255)) for k in keys]
    levels = np.zeros(trees, dtype=np.int64)
    for t, n in open_:
        levels[t] = max(levels[t], n.bit_length() - 1)
    return Paths(
        np.array([place[t, 1] for t in range(trees)]), levels, np.array([f for f, _ in split]), np.array([c for _, c in split], dtype=np.uint8),
        np.array([place.get((t, 2 * n), i) for i, (t, n) in enumerate(keys)]), np.array([slots.get(k, -1) for k in keys]))


def _members(paths: Paths, tree: int, keys: np.ndarray, flat: np.ndarray, d: int, bagged: bool, seed: int) -> tuple[np.ndarray, ...]:
    """(rows, weights, slots) of a part of the rows in the open nodes of a tree."""
    rows, w = bag(keys, tree, seed) if bagged else (np.arange(len(keys)), np.ones(len(keys), dtype=np.int64))
    slot = paths.slots(tree, flat, rows * d)
    inside = slot >= 0
    if not inside.all():
        rows, w, slot = rows[inside], w[inside], slot[inside]
    return rows, w, slot


def _level(data: DataFrame, paths: Paths, nodes: list[tuple[int, int]], known: list[int], k: int, lay: Layout, bagged: bool) -> list[Row]:
    """Split, or counts as a leaf, of every open node, from one pass over ``k`` features of each that are not ``known`` to be the same in all its rows.

    Rows are (tree, node, feature, code, n0, n1, left n0, left n1, sides with one code, features that proved to be the same).
    """
    d, codes_of = len(lay.sizes), int(lay.sizes.max())
    free = np.array([[not m >> f & 1 for f in range(d)] for m in known])
    order = orders(nodes, lay)
    free = np.take_along_axis(free, order, axis=1)
    first = np.argsort(~free, axis=1, kind="stable")[:, :k]  # the free ones, in the node's order
    chosen = np.where(np.take_along_axis(free, first, axis=1), np.take_along_axis(order, first, axis=1), -1)
    shared = data.sparkSession.sparkContext.broadcast((paths, nodes, chosen, free.sum(axis=1) <= k))
    trees = sorted({t for t, _ in nodes})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, nodes, chosen, _ = shared.value
        used = np.ascontiguousarray(np.maximum(chosen, 0).T)  # places without a feature count any, which is not looked at
        own = np.array([t for t, _ in nodes])  # sorted
        spans = [(t, *(int(np.searchsorted(own, t, side)) for side in ("left", "right"))) for t in trees]
        total = np.zeros((len(nodes), k, codes_of * 2))
        for part in _chunks(batches, d):
            keys, y, flat = _rows_of(part, d)
            for t, a, b in spans:
                rows, w, slot = _members(paths, t, keys, flat, d, bagged, lay.seed)
                if not len(rows):
                    continue
                start, w = rows * d, w.astype(float)
                cell = (slot - a) * (codes_of * 2) + y[rows]
                for j in range(k):
                    code = flat.take(start + used[j].take(slot)).astype(np.int64)
                    code *= 2
                    code += cell
                    total[a:b, j] += np.bincount(code, w, (b - a) * codes_of * 2).reshape(b - a, -1)
        met = np.flatnonzero(total.any(axis=(1, 2)))
        step = max(1, COUNT_BYTES // total[:1].nbytes)
        for a in range(0, len(met), step):
            slots = met[a:a + step]
            counts = [total[i].astype(np.int64).tobytes() for i in slots]
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(counts, pa.binary())], ["slot", "counts"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, nodes, chosen, whole = shared.value
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for slot, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(counts, np.int64).reshape(k, -1, 2)
                sums[slot] = sums[slot] + part if slot in sums else part
        out = []
        for slot, counts in sums.items():
            tree, node = nodes[slot]
            features = chosen[slot][chosen[slot] >= 0]
            counts = counts[:len(features)].astype(float)
            own = counts[0].sum(axis=0)
            feature, code, left, alone = best_split(counts, features, node, bool(whole[slot]), lay)
            same = features[counts.any(axis=2).sum(axis=1) < 2].tolist()
            out.append((tree, node, feature, code, int(own[0]), int(own[1]), int(left[0]), int(left[1]), alone, same))
        if out:
            kinds = (*_NODE_TYPES, pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [*_NODE_NAMES, "l0", "l1", "alone", "same"])

    parts = min(len(nodes), int(data.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = data.mapInArrow(count, "slot int, counts binary").repartition(parts, "slot")
    found = counted.mapInArrow(choose, _NODE + ", l0 long, l1 long, alone int, same array<int>").collect()  # one row per open node
    shared.destroy()
    return found


def _branches(data: DataFrame, paths: Paths, nodes: list[tuple[int, int]], lay: Layout, bagged: bool, rows: int) -> DataFrame:
    """Stored nodes of all branches that are grown in one task each; ``rows`` is their number of rows in all."""
    d = len(lay.sizes)
    spark = data.sparkSession
    shared = spark.sparkContext.broadcast((paths, nodes))
    trees = sorted({t for t, _ in nodes})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, _ = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def passed() -> Iterator[pa.RecordBatch]:
            slot = np.concatenate([s for s, _ in held])
            rows = np.concatenate([r for _, r in held])
            order = np.argsort(slot, kind="stable")
            slot, rows = slot[order], rows[order]
            ends = np.flatnonzero(np.diff(slot, append=-1)) + 1
            starts = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot[starts], pa.int32()), pa.array([rows[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())], ["slot", "rows"])

        for part in _chunks(batches, d):
            keys, y, flat = _rows_of(part, d)
            codes = flat.reshape(-1, d)
            for t in trees:
                at, w, slot = _members(paths, t, keys, flat, d, bagged, lay.seed)
                if len(at):
                    held.append((slot.astype(np.int32), np.column_stack([codes[at], y[at].astype(np.uint8), w.astype(np.uint8)])))
                    size += len(at) * (d + 2)
                if size >= BRANCH_BYTES:
                    yield from passed()
                    held, size = [], 0
        if held:
            yield from passed()

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, nodes = shared.value

        def grown() -> Iterator[tuple]:
            now, parts = -1, []
            for b in batches:
                for slot, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if slot != now and parts:
                        yield from branch(now, parts)
                        parts = []
                    now = slot
                    parts.append(np.frombuffer(rows, np.uint8).reshape(-1, d + 2))
            if parts:
                yield from branch(now, parts)

        def branch(slot: int, parts: list[np.ndarray]) -> Iterator[tuple]:
            rows = np.concatenate(parts)
            return grow_branch(np.ascontiguousarray(rows[:, :d]), rows[:, d].astype(np.int64), rows[:, d + 1].astype(float), *nodes[slot], lay)

        yield from _node_batches(grown())

    tasks = min(len(nodes), max(2 * spark.sparkContext.defaultParallelism, rows * (d + 2) // BRANCH_BYTES + 1))
    dealt = data.mapInArrow(deal, "slot int, rows binary").repartition(tasks, "slot").sortWithinPartitions("slot")
    return materialize(dealt.mapInArrow(grow, _NODE), "branches")


@dataclass
class Forest:
    """Fitted trees: nodes in the order of (tree, node), a node's children next to each other."""

    features: list[str]
    cuts: list[np.ndarray]
    trees: int
    tree: np.ndarray
    node: np.ndarray
    feature: np.ndarray  # -1 for a leaf
    code: np.ndarray
    n0: np.ndarray
    n1: np.ndarray

    def __post_init__(self) -> None:
        place = self.tree.astype(np.int64) << 40 | self.node
        self.roots = np.searchsorted(place, np.arange(self.trees, dtype=np.int64) << 40 | 1)
        self.left = np.where(self.feature >= 0, np.searchsorted(place, self.tree.astype(np.int64) << 40 | (2 * self.node)), -1)
        self.share = self.n1 / np.maximum(self.n0 + self.n1, 1)

    @property
    def depth(self) -> int:
        return int(self.node.max()).bit_length() - 1

    def importances(self) -> np.ndarray:
        """Impurity decrease by feature: per tree in shares of one, then the mean over the trees that split at all."""
        n = (self.n0 + self.n1).astype(float)
        impurity = n - (self.n0.astype(float) ** 2 + self.n1.astype(float) ** 2) / np.maximum(n, 1)
        inner = np.flatnonzero(self.feature >= 0)
        gain = impurity[inner] - impurity[self.left[inner]] - impurity[self.left[inner] + 1]
        table = np.zeros((self.trees, len(self.features)))
        np.add.at(table, (self.tree[inner], self.feature[inner]), gain)
        whole = table.sum(axis=1, keepdims=True)
        table = np.divide(table, whole, out=np.zeros_like(table), where=whole > 0)
        out = table.sum(axis=0)
        return out / out.sum() if out.sum() > 0 else out

    def transform(self, df: DataFrame, probability: str = "probability_1", prediction: str = "prediction") -> DataFrame:
        """Add P(class 1), the mean of the trees' shares, and the more likely class."""
        ship_package(df.sparkSession)
        inner = self.feature >= 0
        nodes = np.where(inner, self.feature, 0), np.where(inner, self.code, 255).astype(np.uint8), np.where(inner, self.left, np.arange(len(inner)))
        depths = np.array([int(self.node[a:b].max()).bit_length() - 1 for a, b in zip(self.roots, [*self.roots[1:], len(self.node)])])
        shared = df.sparkSession.sparkContext.broadcast((self.cuts, self.roots, depths, nodes, self.share))

        @F.pandas_udf("double")
        def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            cuts, roots, depths, nodes, share = shared.value
            for part in parts:
                codes = coded([part.iloc[:, i].to_numpy(float) for i in range(part.shape[1])], cuts)
                flat, start = codes.ravel(), np.arange(len(codes)) * codes.shape[1]
                shares = np.empty((len(codes), len(roots)))
                for t, (root, levels) in enumerate(zip(roots.tolist(), depths.tolist())):
                    shares[:, t] = share.take(_walk(flat, start, root, levels, *nodes))
                yield pd.Series(shares.mean(axis=1))

        out = df.withColumn(probability, score(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(self.features)])))
        return out.withColumn(prediction, (F.col(probability) > 0.5).cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Overwrite ``path`` with the nodes and the cuts as Parquet."""
        nodes = pd.DataFrame({c: getattr(self, c) for c in _NODE_NAMES})
        spark.createDataFrame(nodes, _NODE).write.mode("overwrite").parquet(f"{path}/nodes")
        cuts = [(i, c, [float(v) for v in own]) for i, (c, own) in enumerate(zip(self.features, self.cuts))]
        spark.createDataFrame(cuts, "place int, feature string, cuts array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        """Read a forest that :meth:`save` wrote; a missing path is an error."""
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        cuts = spark.read.parquet(f"{path}/cuts").orderBy("place").collect()
        return Forest([r["feature"] for r in cuts], [np.array(r["cuts"], dtype=float) for r in cuts], int(nodes["tree"].max()) + 1,
                      *[nodes[c].to_numpy() for c in _NODE_NAMES])

    def table(self, spark: SparkSession) -> DataFrame:
        """The nodes, one row each; an inner node sends values up to ``cut`` to node 2n, larger ones to 2n + 1."""
        cut = [float(self.cuts[f][c]) if f >= 0 else None for f, c in zip(self.feature, self.code)]
        names = [self.features[f] if f >= 0 else None for f in self.feature]
        rows = list(zip(self.tree.tolist(), self.node.tolist(), names, cut, self.n0.tolist(), self.n1.tolist()))
        return spark.createDataFrame(rows, "tree int, node long, feature string, cut double, n0 long, n1 long")


def fit_forest(
    df: DataFrame, cols: Sequence[str], label: str, key: str, trees: int = 100, max_depth: int = 30, bins: int = 64,
    usable: int | None = None, bagged: bool = True, seed: int = SEED, local_rows: int = LOCAL_ROWS,
) -> Forest:
    """Grow ``trees`` trees on 0/1 labels. ``key`` tells rows apart for the bags; ``usable`` is by default the root of the number of columns.

    ``max_depth`` 30 stands for unbounded. NULL features are an error: impute them first.
    """
    cols = list(cols)
    if not cols or not 0 <= max_depth <= 38:
        raise ValueError("needs a feature, and a depth of at most 38")
    cuts = find_cuts(df, cols, bins)
    data = encode(df, cols, cuts, label, key)
    lay = Layout(np.array([len(c) + 1 for c in cuts]), usable or max(1, int(math.sqrt(len(cols)))), max_depth, seed)
    rows = data.count()
    if not rows:
        raise ValueError("no rows to fit")
    d, codes_of = len(cols), int(lay.sizes.max())
    every = (1 << d) - 1
    splits: dict[tuple[int, int], tuple[int, int]] = {}
    nodes: list[tuple] = []
    local: list[tuple[int, int]] = []
    local_size = 0
    known: dict[tuple[int, int], int] = {}  # per open node, bits of the features that are the same in all its rows
    tried: set[tuple[int, int]] = set()
    open_ = [(t, 1) for t in range(trees)]
    if rows <= local_rows:
        local, open_, local_size = open_, [], rows * (trees if bagged else 1)
    while open_:
        k = d if tried.issuperset(open_) else min(d, lay.usable + SPARE)  # undecided nodes alone are not put off again
        per_pass = max(1, HISTOGRAM_BYTES // (k * codes_of * 16))
        later: list[tuple[int, int]] = []
        for a in range(0, len(open_), per_pass):
            now = open_[a:a + per_pass]
            for t, n, f, c, n0, n1, l0, l1, alone, same in _level(data, _paths(trees, splits, now), now, [known.get(o, 0) for o in now], k, lay, bagged):
                mask = known.pop((t, n), 0) | sum(1 << i for i in same)
                if f == UNDECIDED:
                    known[t, n] = mask
                    tried.add((t, n))
                    later.append((t, n))
                    continue
                nodes.append((t, n, f, c, n0, n1))
                if f == LEAF:
                    continue
                splits[t, n] = (f, c)
                for side, child, c0, c1 in ((1, 2 * n, l0, l1), (2, 2 * n + 1, n0 - l0, n1 - l1)):
                    own, left = mask | (1 << f if alone & side else 0), max_depth + 1 - child.bit_length()
                    if not c0 or not c1 or not left or own == every:
                        nodes.append((t, child, LEAF, 0, c0, c1))
                    elif c0 + c1 <= local_rows and left >= LOCAL_LEVELS:
                        local.append((t, child))
                        local_size += c0 + c1
                    else:
                        known[t, child] = own
                        later.append((t, child))
        open_ = sorted(later)
    parts = [pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes), _NODE_TYPES)], _NODE_NAMES)] if nodes else []
    if local:
        local.sort()
        grown = _branches(data, _paths(trees, splits, local), local, lay, bagged, local_size)
        size = grown.count()
        if size > MAX_NODES:
            raise ValueError(f"{size} nodes; take a smaller max_depth or fewer trees")
        parts.append(grown.toArrow().select(_NODE_NAMES))
    table = pa.concat_tables(parts)
    columns = [table.column(c).to_numpy() for c in _NODE_NAMES]
    missing = sorted({(t, 1) for t in range(trees)} - set(zip(columns[0].tolist(), columns[1].tolist())))
    if missing:  # a bag without rows is a leaf that knows nothing
        columns = [np.append(c, [m[i] if i < 2 else (-1 if i == 2 else 0) for m in missing]) for i, c in enumerate(columns)]
    order = np.lexsort((columns[1], columns[0]))
    return Forest(cols, cuts, trees, *[c[order] for c in columns])


def fit_tree(df: DataFrame, cols: Sequence[str], label: str, key: str, max_depth: int = 5, bins: int = 128, seed: int = SEED) -> Forest:
    """One tree on all rows and all features."""
    return fit_forest(df, cols, label, key, 1, max_depth, bins, len(cols), False, seed)
