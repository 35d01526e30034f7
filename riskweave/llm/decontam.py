"""Benchmark items inside documents, by MinHash signatures partitioned by the item's size, and exact containment.

The share of an item's minimum-hash shingles that a document has estimates the share of all its shingles, however long
the document is, as each of them is a random shingle of the item (containment MinHash, Koslicki and Zabeti 2019). Items are
partitioned by size, in powers of two, and each partition has its signature:

* Up to ``2 ** SMALL`` shingles: one hash function and as many smallest hashes as the item's size asks for. Of ``n`` shingles
  ``m`` must be in a document, so the ``n - m + 1`` smallest hold one that is there: no pair can be missed.
* Above: the smallest hash of each of ``HASHES`` functions. A document with fewer of them than a pair at the threshold has, but for a
  chance of ``LOSS``, is no candidate (4 of 24 at 75 %), whatever the sizes.

Candidates are verified by the share of the item's distinct shingles in the whole document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.llm.common import ascii_lower, bounded, computed, without, words
from riskweave.session import materialize

LENGTH = 5
#: Size class (a power of two) up to which a signature misses no pair; hash functions above, and the chance of losing a pair there.
SMALL, HASHES, LOSS = 6, 24, 1e-9


def _identity(docs: DataFrame) -> DataFrame:
    """Rows with equal doc_id and text are one document; NULL text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("_mark"), text.alias("_text"))


def _numbered(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per shingle: ``keys``, ``at`` (its number), ``w`` (all words), of rows with ``_text``.

    With fewer than ``LENGTH`` words the whole sequence is the one shingle.
    """
    rows = computed(rows.select(*keys, "_text"), words(ascii_lower(F.col("_text"))).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - LENGTH, F.lit(0))
    return rows.select(*keys, "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))


def _mark_of(at: Column) -> Column:
    """Fingerprint of the shingle at ``at``; missing words count as NULL and change nothing."""
    return F.xxhash64(*[F.get("w", at + i) for i in range(LENGTH)])


def _shingle(at: Column) -> Column:
    return F.concat_ws(" ", *[F.get("w", at + i) for i in range(LENGTH)])


def item_shingles(items: DataFrame) -> DataFrame:
    """``item_id``, ``n_item`` (distinct shingles), ``fp``, ``shingle``. Repeated items count once."""
    base = items.select("item_id", F.coalesce("text", F.lit("")).alias("_text")).where("item_id IS NOT NULL")
    rows = _numbered(base, "item_id").select("item_id", _mark_of(F.col("at")).alias("fp"), _shingle(F.col("at")).alias("shingle")).distinct()
    sizes = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    return rows.join(sizes, "item_id")


def _matches(percent: int) -> int:
    """Entries of a large item's signature that a document with ``percent`` of its shingles has, but for a chance of ``LOSS``."""
    p, below = percent / 100, 0.0
    for k in range(HASHES):
        below += math.comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        if below > LOSS:
            return max(k, 1)
    return HASHES


def signatures(shingles: DataFrame, percent: int) -> DataFrame:
    """``item_id``, ``fp``, ``at`` (which entry of the signature), ``part`` (the item's size class) and ``need`` (entries a document must have)."""
    needed = F.ceil(F.col("n_item") * percent / 100)
    part = F.length(F.bin(F.col("n_item") - 1))  # 2 ** part is the largest size of the class
    sized = shingles.select("item_id", "fp", part.alias("part"), F.greatest(F.col("n_item") - needed + 1, F.lit(1)).cast("int").alias("spare"))
    place = F.row_number().over(W.partitionBy("item_id").orderBy(F.xxhash64("fp"), "fp"))
    small = sized.where(F.col("part") <= SMALL).withColumn("at", place).where("at <= spare")
    each = sized.where(F.col("part") > SMALL).select("*", F.explode(F.sequence(F.lit(1), F.lit(HASHES))).alias("at"))
    large = each.groupBy("item_id", "part", "at").agg(F.min_by("fp", F.struct(F.xxhash64("fp", "at"), "fp")).alias("fp"))
    columns = ["item_id", "fp", "at", "part"]
    return small.select(*columns, F.lit(1).alias("need")).unionByName(large.select(*columns, F.lit(_matches(percent)).alias("need")))


def leaks(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """Pairs ``doc_id``, ``_mark`` (hash of the text), ``item_id``, ``n_item``, ``n_shared``.

    A document holds an item if at least ``percent`` of the item's distinct shingles are among
    the document's, wherever they are in it and however long it is. Items without words are in no document.
    Other columns of either table are not carried.
    """
    shingles = materialize(item_shingles(items), "item-shingles")
    keys = materialize(signatures(shingles, percent), "item-signatures")

    rows = _identity(docs)
    found = _numbered(rows, "doc_id", "_mark").select("doc_id", "_mark", _mark_of(F.col("at")).alias("fp"))
    met = found.join(bounded(keys, keys.count()), "fp").groupBy("doc_id", "_mark", "item_id", "part", "need").agg(F.count_distinct("at").alias("entries"))
    hits = met.where(F.col("entries") >= F.col("need")).select(F.col("doc_id").alias("_d"), F.col("_mark").alias("_m")).distinct()
    near = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_mark") == F.col("_m")))
    near = materialize(near.select("doc_id", "_mark", "_text"), "near")

    exact = _numbered(near, "doc_id", "_mark").select("doc_id", "_mark", "at", "w", _mark_of(F.col("at")).alias("fp"))
    own = shingles.select("fp", "shingle", "item_id", "n_item")
    exact = exact.join(bounded(own, shingles.count()), "fp").where(_shingle(F.col("at")) == F.col("shingle"))
    shared = exact.groupBy("doc_id", "_mark", "item_id", "n_item").agg(F.count_distinct("shingle").alias("n_shared"))
    return shared.where(100 * F.col("n_shared") >= percent * F.col("n_item"))


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """Rows of ``docs``, with all their columns, that hold no item."""
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    return without(docs, leaks(docs, items, percent), {"doc_id": F.col("doc_id"), "_mark": mark})
