"""Frequent itemsets and association rules."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.session import materialize

# Up to this many items all subsets of the distinct baskets are enumerated (3^12 at most).
MASK_ITEMS = 12
# Baskets of one block of bitmaps; candidates counted in one pass; frequent sets that are still brought together.
BLOCK, CANDIDATES, MAX_SETS = 1 << 16, 1 << 18, 1 << 21

ITEMSET_SCHEMA = "items array<string>, freq bigint, n_items int, support double"


def flags_mask(items: Sequence[str]) -> Column:
    """Bit set of the columns that are not zero; NULL if any of them is NULL."""
    bits = [F.when(F.col(c).isNotNull(), F.when(F.col(c) != 0, F.lit(1 << i)).otherwise(0)) for i, c in enumerate(items)]
    return sum(bits[1:], bits[0])


def basket_masks(df: DataFrame, keys: Sequence[str], item: str, items: Sequence[str]) -> DataFrame:
    """One row per basket with the bit set of its items, combined before the shuffle.

    ``items`` has to name every value; :func:`item_values` reads them from the data.
    """
    bit = F.lit(0)
    for i, v in enumerate(items):
        bit = F.when(F.col(item) == F.lit(v), F.lit(1 << i)).otherwise(bit)
    return df.groupBy(*keys).agg(F.bit_or(bit).alias("mask"))


def item_values(df: DataFrame, item: str) -> list | None:
    """All values of a column of few values, sorted; None if there are more than fit a bit set."""
    found = [r[0] for r in df.select(item).where(F.col(item).isNotNull()).distinct().limit(MASK_ITEMS + 1).collect()]
    return sorted(found) if len(found) <= MASK_ITEMS else None


def basket_itemsets(df: DataFrame, keys: Sequence[str], item: str, min_support: float = 0.1) -> DataFrame:
    """Frequent itemsets of the baskets that ``keys`` name, with any number of different items."""
    values = item_values(df, item)
    if values is not None:
        return mask_itemsets(basket_masks(df, keys, item, values), values, min_support)
    return vertical_itemsets(df.groupBy(*keys).agg(F.collect_set(F.col(item).cast("string")).alias("items")), min_support)


def _mask_items(mask: Column, items: Sequence[str]) -> Column:
    names = F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(v)) for i, v in enumerate(items)])
    return F.array_sort(F.array_compact(names))


def mask_itemsets(masks: DataFrame, items: Sequence[str], min_support: float = 0.1) -> DataFrame:
    """Frequent itemsets of a ``mask`` column over at most ``MASK_ITEMS`` items.

    Baskets collapse to at most 2^items distinct sets with counts before
    anything is enumerated, so the expansion does not grow with the table.
    Baskets without items count in the total.
    """
    if len(items) > MASK_ITEMS:
        raise ValueError(f"more than {MASK_ITEMS} items; use itemsets()")
    distinct = masks.where(F.col("mask").isNotNull()).groupBy("mask").agg(F.count("*").alias("n"))
    everything = F.sequence(F.lit(0), F.lit((1 << len(items)) - 1))
    subset = F.explode(F.filter(everything, lambda s: s.bitwiseAND(F.col("mask")) == s))
    freq = distinct.select(subset.alias("sub"), "n").groupBy("sub").agg(F.sum("n").alias("freq"))
    # The empty set is a subset of every basket, so its count is the number of baskets.
    total = F.max(F.when(F.col("sub") == 0, F.col("freq"))).over(W.partitionBy(F.lit(0)))
    sized = freq.withColumn("total", total).where("sub > 0")
    support = F.col("freq") / F.col("total")
    return sized.where(support >= F.lit(min_support)).select(
        _mask_items(F.col("sub"), items).alias("items"), "freq",
        F.bit_count("sub").cast("int").alias("n_items"), support.alias("support"),
    )


def itemsets(df: DataFrame, items: Sequence[str], min_support: float = 0.1) -> DataFrame:
    """Frequent itemsets of 0/1 columns: rows (items, freq, n_items, support).

    Rows with a NULL flag are left out. Item lists that are too wide for bit sets go to bitmaps per item.
    """
    if len(items) <= MASK_ITEMS:
        return mask_itemsets(df.select(flags_mask(items).alias("mask")), items, min_support)
    complete = df.dropna(subset=list(items))
    sets = complete.select(F.array_compact(F.array(*[F.when(F.col(c) != 0, F.lit(c)) for c in items])).alias("items"))
    return vertical_itemsets(sets, min_support)


def _bitmaps(baskets: DataFrame, names: list[str]) -> DataFrame:
    """Stored blocks of baskets: ``n`` of them, and ``bits``, one bitmap of ``BLOCK`` bits per frequent item in their order."""
    values = pa.array(names, pa.string())

    def block(lists: pa.Array) -> bytes:
        size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        code = pc.index_in(lists.flatten(), value_set=values)
        known = code.is_valid().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists)), size)[known]
        table = np.zeros((len(names), BLOCK), dtype=bool)
        table[code.drop_null().to_numpy(), row] = True
        return np.packbits(table, axis=1).tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        for b in batches:
            lists = b.column(0)
            while len(lists):
                room = BLOCK - sum(map(len, held))
                held.append(lists.slice(0, room))
                lists = lists.slice(room)
                if sum(map(len, held)) == BLOCK:
                    yield pa.record_batch([pa.array([block(pa.concat_arrays(held))], pa.binary())], ["bits"])
                    held = []
        if held:
            yield pa.record_batch([pa.array([block(pa.concat_arrays(held))], pa.binary())], ["bits"])

    return materialize(baskets.mapInArrow(pack, "bits binary"), "bitmaps", spread=True)


def _joined(level: list[tuple[int, ...]]) -> dict[tuple[int, ...], list[int]]:
    """Candidates one item larger, by their prefix: two sets of a level that differ in the last item, if all smaller sets are frequent."""
    frequent, out = set(level), {}
    for _, group in itertools.groupby(level, key=lambda s: s[:-1]):
        own = list(group)
        for i, a in enumerate(own[:-1]):
            last = [b[-1] for b in own[i + 1:] if all(a[:j] + a[j + 1:] + b[-1:] in frequent for j in range(len(a) - 1))]
            if last:
                out[a] = last
    return out


def _support_counts(blocks: DataFrame, items: int, classes: list[tuple[tuple[int, ...], list[int]]]) -> dict[int, int]:
    """How many baskets hold each candidate, numbered through all classes: the prefix's bitmap is made once a block, and met with every last item's."""
    shared = blocks.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(len(last) for _, last in shared.value), dtype=np.int64)
        for b in batches:
            for bits in b.column(0).to_pylist():
                table = np.frombuffer(bits, np.uint64).reshape(items, -1)
                at = 0
                for prefix, last in shared.value:
                    both = table[last] & np.bitwise_and.reduce(table[list(prefix)], axis=0)
                    total[at:at + len(last)] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
                    at += len(last)
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], ["i", "n"])

    counted = blocks.mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    return {r["i"]: r["n"] for r in counted.collect()}  # one row per candidate, at most CANDIDATES


def vertical_itemsets(df: DataFrame, min_support: float = 0.1) -> DataFrame:
    """Frequent itemsets of an array column ``items`` with any number of distinct items: rows (items, freq, n_items, support).

    Baskets become bitmaps, one per frequent item and block of baskets. Sets are counted level by level as the
    bits that a prefix and a last item have in common, so a pass reads one bit per basket and frequent item, and a
    prefix that many sets share is met once a block, in all tasks. Repeated items of a basket count once; NULL arrays are left out, empty ones
    count in the total. What is brought together are the frequent sets; more than ``MAX_SETS`` are an error.
    """
    spark = df.sparkSession
    baskets = df.where(F.col("items").isNotNull()).select(F.col("items").cast("array<string>").alias("items"))
    total = baskets.count()
    least = next((n for n in (math.floor(min_support * total), math.ceil(min_support * total)) if total and n / total >= min_support), 1)
    least = max(least, 1)
    single = baskets.select(F.explode(F.array_distinct("items")).alias("item")).where("item IS NOT NULL").groupBy("item").count()
    # at most baskets' mean length / min_support items
    found = sorted((r["item"], r["count"]) for r in single.where(F.col("count") >= least).limit(MAX_SETS + 1).collect())
    names = [i for i, _ in found]
    sets = {(i,): n for i, (_, n) in enumerate(found)}
    level = sorted(sets)
    blocks = _bitmaps(baskets, names) if len(names) > 1 else None
    while len(level) > 1 and len(sets) <= MAX_SETS:
        classes = sorted(_joined(level).items())
        level = []
        while classes:
            now, size = [], 0
            while classes and (not now or size + len(classes[-1][1]) <= CANDIDATES):
                now.append(classes.pop())
                size += len(now[-1][1])
            every = [prefix + (x,) for prefix, last in now for x in last]
            fresh = {every[i]: n for i, n in _support_counts(blocks, len(names), now).items() if n >= least}
            sets |= fresh
            level += fresh
        level.sort()
    if len(sets) > MAX_SETS:
        raise ValueError(f"more than {MAX_SETS} frequent sets; ask for a larger support")
    rows = pa.table({
        "items": pa.array([[names[i] for i in s] for s in sets], pa.list_(pa.string())), "freq": pa.array(sets.values(), pa.int64()),
        "n_items": pa.array(map(len, sets), pa.int32()), "support": pa.array([n / total for n in sets.values()], pa.float64())})
    return spark.createDataFrame(rows, ITEMSET_SCHEMA)


def array_itemsets(df: DataFrame, min_support: float = 0.1) -> DataFrame:
    """Frequent itemsets of an array column ``items`` with any number of distinct items."""
    total = df.where(F.col("items").isNotNull()).count()
    if not total:
        return df.sparkSession.createDataFrame([], ITEMSET_SCHEMA)
    # Half a row less, so that rounding cannot raise the threshold; the filter is the same as for masks.
    asked = max(0.0, min_support - 0.5 / total)
    found = FPGrowth(itemsCol="items", minSupport=asked).fit(df).freqItemsets
    support = F.col("freq") / F.lit(total)
    return found.where(support >= F.lit(min_support)).select(
        F.array_sort("items").alias("items"), "freq", F.size("items").alias("n_items"), support.alias("support"))


def rules(frequent: DataFrame, min_confidence: float = 0.6) -> DataFrame:
    """Splits of frequent itemsets into antecedents and consequents, with enough confidence.

    Subsets of a frequent set are frequent, so both sides are looked up in the
    same table. Sets of up to ``MASK_ITEMS`` items are split in all ways at once. Moving an item to the consequents
    never raises the confidence, so for wider sets consequents grow item by item (Agrawal and Srikant 1994)
    and only from rules that passed: no task enumerates the subsets of a wide set. An empty input gives no rows.
    """
    frequent = materialize(frequent.select("items", "support"), "frequent")
    sides = frequent.select(F.col("items").alias("antecedents"), F.col("support").alias("a_support"))
    right = frequent.select(F.col("items").alias("consequents"), F.col("support").alias("c_support"))
    confidence = F.col("support") / F.col("a_support")
    longest = frequent.agg(F.max(F.size("items")).alias("n")).first()["n"] or 0
    if longest <= MASK_ITEMS:  # every split of a narrow set, without a pass per level
        split = F.explode(F.sequence(F.lit(1), F.expr("shiftleft(1, size(items)) - 2"))).alias("__in")
        parts = frequent.where(F.size("items") > 1).select("items", "support", split)
        chosen = F.filter("items", lambda _, i: F.call_function("shiftright", F.col("__in"), i).bitwiseAND(F.lit(1)) == 1)
        parts = parts.select("items", "support", chosen.alias("antecedents"))
        found = parts.join(sides, "antecedents").where(confidence >= F.lit(min_confidence)).select(
            "support", "antecedents", F.array_except("items", "antecedents").alias("consequents"), confidence.alias("confidence"))
    else:
        found = _grown_rules(frequent, sides, min_confidence, longest)
    return found.join(right, "consequents").select(
        "antecedents", "consequents", "support", "confidence", (F.col("confidence") / F.col("c_support")).alias("lift"))


def _grown_rules(frequent: DataFrame, sides: DataFrame, min_confidence: float, longest: int) -> DataFrame:
    """Rules of sets of any width, their consequents grown item by item."""
    level = frequent.where(F.size("items") > 1).select("items", "support", F.array().cast("array<string>").alias("consequents"))
    found = None
    for _ in range(longest - 1):
        last = F.coalesce(F.try_element_at("consequents", F.lit(-1)), F.lit(""))
        grown = level.withColumn("__last", last).withColumn("__more", F.explode("items"))
        grown = grown.where((F.col("__more") > F.col("__last")) | (F.size("consequents") == 0))
        grown = grown.select("items", "support", F.array_append("consequents", F.col("__more")).alias("consequents"))
        grown = grown.where(F.size("consequents") < F.size("items"))
        grown = grown.withColumn("antecedents", F.array_except("items", "consequents")).join(sides, "antecedents")
        confidence = F.col("support") / F.col("a_support")
        level = materialize(grown.where(confidence >= F.lit(min_confidence)).select(
            "items", "support", "antecedents", "consequents", confidence.alias("confidence")), "rules")
        found = level if found is None else found.unionByName(level)
    return found


def top_rules(found: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` rules with the highest lift; ties by confidence, support and item names.

    Measures are compared to nine digits, so round-off does not decide ties.
    """
    return found.orderBy(
        F.desc(F.round("lift", 9)), F.desc(F.round("confidence", 9)), F.desc(F.round("support", 9)),
        "antecedents", "consequents",
    ).limit(k)
