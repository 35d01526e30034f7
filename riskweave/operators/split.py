"""Exact train/test splits that depend on row identity, not on row position."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.operators.warehouse import with_dense_key
from riskweave.session import materialize

# Rows of one hash prefix that a single task ranks.
RANK_ROWS = 1_000_000
# Classes whose last test rows are still broadcast; beyond, they are joined by shuffling.
BROADCAST_CLASSES = 100_000


def _order_hash(keys: Sequence[str], seed: int | None) -> Column:
    parts = [F.col(k) for k in keys] + ([F.lit(seed)] if seed is not None else [])
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def quotas(counts: Sequence[int], share: float) -> list[int]:
    """Test rows of each of a few classes, in their order; :func:`quota_table` does any number."""
    total = sum(counts)
    train = total - math.ceil(share * total)
    exact = [train * c / total if total else 0.0 for c in counts]
    base = [math.floor(e) for e in exact]
    by_remainder = sorted(range(len(counts)), key=lambda i: (-(exact[i] - base[i]), i))
    for i in by_remainder[: train - sum(base)]:
        base[i] += 1
    return [c - b for c, b in zip(counts, base)]


def quota_table(counts: DataFrame, share: float, few: bool = False) -> DataFrame:
    """``counts`` (c, n) with ``q``, the test rows of each class.

    Training rows are apportioned by largest remainder, ties in class order (NULL first). ``few`` classes (up to
    ``BROADCAST_CLASSES``) are ranked by one task, more of them by a dense key, so there may be any number.
    """
    whole = counts.agg(F.sum("n").alias("total")).first()["total"] or 0
    train = whole - math.ceil(share * whole)
    exact = F.lit(train) * F.col("n") / F.lit(float(max(whole, 1)))
    base = counts.withColumn("base", F.floor(exact)).withColumn("less", F.col("base") - exact).withColumn("known", F.col("c").isNotNull())
    if few:
        every = W.partitionBy(F.lit(0))
        placed = base.withColumn("place", F.row_number().over(every.orderBy("less", "known", "c"))).withColumn("spare", train - F.sum("base").over(every))
        return placed.select("c", "n", (F.col("n") - F.col("base") - (F.col("place") <= F.col("spare")).cast("int")).alias("q"))
    base = materialize(base, "quotas")
    spare = train - (base.agg(F.sum("base").alias("s")).first()["s"] or 0)
    ranked = with_dense_key(base, ["less", "known", "c"], "place")
    return ranked.select("c", "n", (F.col("n") - F.col("base") - (F.col("place") <= F.lit(spare)).cast("int")).alias("q"))


def mark_test(
    df: DataFrame, keys: Sequence[str], share: float = 0.2, stratify: str | None = None, seed: int | None = None,
    rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """Add ``is_test``: the rows with the smallest hashes of their class, up to its quota.

    ``keys`` must tell the rows apart. Ranking all rows of a class in one window
    would put a whole class into one task. Instead rows are counted by hash prefix,
    and the one prefix per class in which the quota ends is split further until it
    holds at most ``rank_rows`` rows. Those are ranked, and every row is compared
    with the last test row found there. Quotas, prefixes and last rows are tables, so the number
    of classes has no bound; while it is small the rows themselves are never shuffled.
    """
    label = F.col(stratify) if stratify else F.lit(0)
    tagged = df.withColumn("__h", _order_hash(keys, seed))
    slim = tagged.select(label.alias("c"), "__h", *keys)

    def ending(rows: DataFrame, quota: DataFrame, digits: int) -> DataFrame:
        """Per class the prefix in which its quota ends: (c, p, q still to take, rows n)."""
        counts = rows.groupBy("c", F.substring("__h", 1, digits).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        joined = counts.join(quota.select(F.col("c").alias("__c"), "q"), F.col("c").eqNullSafe(F.col("__c")))
        before = F.coalesce(F.sum("n").over(W.partitionBy("c").orderBy("p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        placed = joined.withColumn("q", F.col("q") - before)  # at most 256 prefixes per class
        return placed.where((F.col("q") > 0) & (F.col("q") <= F.col("n"))).select("c", "p", "q", "n")

    totals = materialize(slim.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "classes")
    few = totals.count() <= BROADCAST_CLASSES
    small = F.broadcast if few else (lambda rows: rows)
    ends = materialize(ending(slim, quota_table(totals, share, few).where("q > 0"), 2), "cuts")
    digits = 2
    while digits < 32 and (ends.agg(F.max("n").alias("n")).first()["n"] or 0) > rank_rows:
        digits += 2
        inside = ends.select(F.col("c").alias("__c"), F.col("p").alias("__p"))
        part = slim.join(small(inside), F.col("c").eqNullSafe(F.col("__c")) & (F.substring("__h", 1, digits - 2) == F.col("__p")))
        ends = materialize(ending(part.select(*slim.columns), ends, digits), "cuts")

    rank = F.row_number().over(W.partitionBy("c").orderBy("__h", *keys))
    inside = ends.select(F.col("c").alias("__c"), F.col("p").alias("__p"), "q")
    part = slim.join(small(inside), F.col("c").eqNullSafe(F.col("__c")) & F.col("__h").startswith(F.col("__p")))
    last = materialize(part.withColumn("__r", rank).where(F.col("__r") == F.col("q")).select(
        F.col("c").alias("__c"), F.struct("__h", *keys).alias("__last")), "last-rows")
    joined = tagged.join(small(last), label.eqNullSafe(F.col("__c")), "left")
    is_test = F.coalesce(F.struct("__h", *keys) <= F.col("__last"), F.lit(False))
    return joined.select(*df.columns, is_test.alias("is_test"))


def split(
    df: DataFrame, keys: Sequence[str], share: float = 0.2, stratify: str | None = None, seed: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, test) frames of :func:`mark_test`."""
    marked = mark_test(df, keys, share, stratify, seed)
    return (marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test"))
