"""Exact order statistics without sorting the table or collecting a column."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.session import materialize

# Rows of one open interval that are counted value by value.
DIRECT_ROWS = 50_000


@dataclass
class _Search:
    """Search for the value of 0-based ``rank``, known to lie in the open (lo, hi).

    ``upto_lo`` rows are at most ``lo`` and ``under_hi`` rows are less than ``hi``.
    """

    column: str
    rank: int
    upto_lo: int
    under_hi: int
    lo: float | None = None
    hi: float | None = None
    found: float | None = None

    @property
    def inside(self) -> int:
        return self.under_hi - self.upto_lo

    @property
    def interval(self) -> tuple:
        return self.column, self.lo, self.hi

    def between(self) -> Column:
        x = F.col(self.column)
        cond = x.isNotNull()
        if self.lo is not None:
            cond &= x > F.lit(self.lo)
        if self.hi is not None:
            cond &= x < F.lit(self.hi)
        return cond

    def learn(self, value: float, less: int, equal: int) -> None:
        """Use that ``less`` rows are below ``value`` and ``equal`` rows share it."""
        if less <= self.rank < less + equal:
            self.found = value
        elif self.rank < less:
            if self.hi is None or value < self.hi:
                self.hi, self.under_hi = value, less
        elif self.lo is None or value > self.lo:
            self.lo, self.upto_lo = value, less + equal


def _narrow(df: DataFrame, open_: list[_Search], direct_rows: int, max_accuracy: int) -> None:
    """Shrink every interval with one sketch pass and one counting pass.

    The sketch is as fine as one more round needs, up to ``max_accuracy``. It
    guarantees a rank error of ``inside / accuracy``, so the wanted rank is in a
    bracket two errors wide on each side. Rows equal to a bracket end are counted
    apart, so a value shared by many rows ends the search instead of stalling it.
    """
    widest = max(s.inside for s in open_)
    accuracy = min(max_accuracy, max(100, 8 * widest // direct_rows))
    # Searches in the same interval of a column share one sketch.
    shared: dict[tuple, list[_Search]] = {}
    for s in open_:
        shared.setdefault(s.interval, []).append(s)
    sketches = []
    for i, group in enumerate(shared.values()):
        at = [(s.rank - s.upto_lo) / max(1, s.inside - 1) for s in group]
        probs = sorted({p for x in at for p in (max(0.0, x - 2 / accuracy), min(1.0, x + 2 / accuracy))})
        values = F.when(group[0].between(), F.col(group[0].column))
        sketches.append(F.percentile_approx(values, probs, accuracy).alias(f"s{i}"))
    cuts = [(group, v) for group, values in zip(shared.values(), df.agg(*sketches).first()) for v in sorted(set(values))]
    # Counted inside the interval only; how many rows lie below it is known.
    inside = [(g[0].between(), F.col(g[0].column), F.lit(v)) for g, v in cuts]
    counts = df.agg(*[count for b, x, v in inside for count in (F.count_if(b & (x < v)), F.count_if(b & (x == v)))]).first()
    below = {id(s): s.upto_lo for s in open_}  # learn() moves it
    for i, (group, v) in enumerate(cuts):
        for s in group:
            s.learn(v, below[id(s)] + counts[2 * i], counts[2 * i + 1])


def _count_values(df: DataFrame, searches: list[_Search]) -> None:
    """Find the ranks by running counts over the distinct values of each interval."""
    groups: dict[tuple, list[_Search]] = {}
    for s in searches:
        groups.setdefault(s.interval, []).append(s)
    keyed = list(groups.values())
    entries = [
        F.struct(F.lit(i).alias("g"), F.when(g[0].between(), F.col(g[0].column)).alias("v"))
        for i, g in enumerate(keyed)
    ]
    used = reduce(or_, [g[0].between() for g in keyed])
    counts = (
        df.where(used).select(F.inline(F.array(*entries))).where(F.col("v").isNotNull())
        .groupBy("g", "v").agg(F.count("*").alias("n"))
    )
    upto = F.sum("n").over(W.partitionBy("g").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    running = counts.withColumn("upto", upto)
    wanted = [
        (F.col("g") == i) & (F.col("upto") > s.rank - s.upto_lo) & (F.col("upto") - F.col("n") <= s.rank - s.upto_lo)
        for i, g in enumerate(keyed) for s in g
    ]
    rows = running.where(reduce(or_, wanted)).collect()  # at most one row per searched rank
    for r in rows:
        for s in keyed[r["g"]]:
            if r["upto"] - r["n"] <= s.rank - s.upto_lo < r["upto"]:
                s.found = r["v"]


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    direct_rows: int = DIRECT_ROWS,
    max_accuracy: int = 10_000,
) -> dict[str, list[float | None]]:
    """Quantiles of each column with linear interpolation, NULL for empty columns.

    The first passes are aggregations over the table, later ones over the rows in the
    intervals that are still open; these shrink up to ``max_accuracy / 4``-fold a round until at most ``direct_rows`` rows are left in
    one, whose distinct values are then counted and summed up in order.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    sizes = doubles.agg(*[F.count(c).alias(c) for c in cols]).first()
    places: dict[tuple[str, int], _Search] = {}
    for c in cols:
        for p in probs:
            if sizes[c]:
                at = p * (sizes[c] - 1)
                for rank in {math.floor(at), math.ceil(at)}:
                    places[c, rank] = _Search(c, rank, 0, sizes[c])
    while True:
        wide = [s for s in places.values() if s.found is None and s.inside > direct_rows]
        if not wide:
            break
        _narrow(doubles, wide, direct_rows, max_accuracy)
        left = [s for s in places.values() if s.found is None]
        if left:  # a few rows in ten thousand lie in an open interval; later passes read only those
            doubles = materialize(doubles.where(reduce(or_, [s.between() for s in left])), "intervals")
    rest = [s for s in places.values() if s.found is None]
    if rest:
        _count_values(doubles, rest)

    def value(c: str, p: float) -> float | None:
        if not sizes[c]:
            return None
        at = p * (sizes[c] - 1)
        low, high = places[c, math.floor(at)].found, places[c, math.ceil(at)].found
        return low + (high - low) * (at - math.floor(at))

    return {c: [value(c, p) for p in probs] for c in cols}
