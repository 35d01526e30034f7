"""Collocations by multikey three-way quicksort of suffix pointers.

A suffix starts at a word of a piece and has up to five words. All suffixes are routed by their
leading words; a task sorts its share as strings of words, three ways around a pivot word, and goes one
word deeper in the equal part only. The size of an equal part is the count of the phrase its
suffixes share, and a part that is too small for any candidate is abandoned.

Words are 64-bit hashes that depend on the language. That no two words share one is checked over
all words of the table, and another seed is taken if two do, so counts are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.llm.common import small_batches
from riskweave.session import materialize, ship_package

LONGEST = 5
#: Text bytes tokenised at once, and words whose suffixes are pre-aggregated together.
CHUNK_BYTES, CHUNK_WORDS = 1 << 22, 1 << 20
#: Suffix rows of one task, and rows from which the suffixes of a leading phrase are routed by more words.
ROUTE_ROWS = 400_000
#: Bits of the table that tells which pairs of words may be frequent: 4 MB at any size of the input.
PAIR_BITS = 25
#: Candidates of a language are ranked in this many parts before the best of each part are ranked together.
RANK_PARTS = 64

_KIND = np.zeros(256, dtype=np.uint8)  # 1 separates words, 2 separates pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LONG_WORD = 48


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Pieces:
    """Words of texts of one language: hashes, and for every word whether the next one is in the same piece."""

    def __init__(self, texts: list[bytes], lang: str, seed: int):
        self.data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
        kind = _KIND[self.data]
        inside = kind == 0
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[::2], edge[1::2]
        piece = np.searchsorted(np.flatnonzero(kind == 2), self.start)
        self.follows = np.zeros(len(self.start), dtype=bool)
        self.follows[:-1] = piece[1:] == piece[:-1]
        self.hash = self._hashes(lang, seed)

    def _hashes(self, lang: str, seed: int) -> np.ndarray:
        base = hashlib.blake2b(lang.encode(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        length = self.end - self.start
        h = np.full(len(length), int.from_bytes(base, "little"), dtype=np.uint64)
        live = np.flatnonzero(length <= _LONG_WORD)
        step = np.uint64(0x9E3779B97F4A7C15 ^ (seed << 1))
        for at in range(_LONG_WORD):
            live = live[length[live] > at]
            if not len(live):
                break
            h[live] = (h[live] ^ (self.data[self.start[live] + at].astype(np.uint64) + np.uint64(1))) * step
            h[live] ^= h[live] >> np.uint64(29)
        for i in np.flatnonzero(length > _LONG_WORD):
            word = hashlib.blake2b(self.data[self.start[i]:self.end[i]].tobytes(), digest_size=8, key=base).digest()
            h[i] = int.from_bytes(word, "little")
        h = _mix(h)
        h[h == 0] = 1  # 0 stands for no word
        return h

    def word(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode()


def _chunks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[str, Pieces]]:
    """Whole texts, put together by language up to a bound; a longer text is handled alone."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.encode()
            held.setdefault(lang, []).append(raw)
            size[lang] = size.get(lang, 0) + len(raw)
            if sum(size.values()) >= CHUNK_BYTES:
                most = max(size, key=size.get)
                yield most, Pieces(held.pop(most), most, seed)
                size.pop(most)
    for lang, texts in held.items():
        yield lang, Pieces(texts, lang, seed)


# --- counts of words and pairs -----------------------------------------------------------------------


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """``lang``, ``h``, ``word``, ``n`` of all words per chunk; a row without a word has all words of a chunk."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, p in _chunks(batches, seed):
            h, first, n = np.unique(p.hash, return_index=True, return_counts=True)
            words = [p.word(i) for i in first]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(h) + 1), pa.string()), pa.array(np.append(h.view(np.int64), 0)), pa.array([*words, None], pa.string()),
                pa.array(np.append(n, len(p.hash)))], ["lang", "h", "word", "n"])

    return texts.mapInArrow(count, "lang string, h long, word string, n long")


def vocabulary(texts: DataFrame, at_least: int) -> tuple[DataFrame, int]:
    """Stored ``lang``, ``h``, ``word``, ``n`` of frequent words and, with NULL as word, of whole languages; and the seed."""
    for seed in range(1, 9):
        exact = word_counts(texts, seed).groupBy("lang", "h", "word").agg(F.sum("n").alias("n"))
        # a hash belongs to one word of one language, or the seed is not used
        per_hash = exact.groupBy("h", F.when(F.col("h") == 0, F.col("lang")).alias("whole")).agg(
            F.count(F.lit(1)).alias("kinds"), F.max("n").alias("n"), F.max_by("word", "n").alias("word"), F.max("lang").alias("lang"))
        kept = materialize(per_hash.where((F.col("n") >= at_least) | (F.col("h") == 0) | (F.col("kinds") > 1)), "vocabulary")
        if not kept.where("kinds > 1").limit(1).count():
            return kept.select("lang", "h", "word", "n"), seed
    raise RuntimeError("two words shared a hash under every seed")


def _pair_slots(p: Pieces) -> np.ndarray:
    """Slot of the pair that begins at each word (of the last word of a piece: of no use)."""
    after = np.zeros_like(p.hash)
    after[:-1] = p.hash[1:]
    return (_mix(p.hash * np.uint64(3) + after) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


_PART = 1 << 15


def frequent_pairs(texts: DataFrame, seed: int, at_least: int) -> np.ndarray:
    """For every slot a bit (packed, lowest first) that tells whether its pairs are together frequent; no frequent pair is missed.

    A task counts into one table of fixed size, up to ``at_least``, and the tables are added in parts.
    """
    kind = np.uint8 if at_least <= 255 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << PAIR_BITS, dtype=kind)
        for _, p in _chunks(batches, seed):
            slot, n = np.unique(_pair_slots(p)[p.follows], return_counts=True)
            table[slot] = np.minimum(table[slot] + n, at_least)
        for part, counts in enumerate(table.reshape(-1, _PART)):
            if counts.any():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sums.setdefault(part, np.zeros(_PART, dtype=np.int64))
                np.minimum(own + np.frombuffer(counts, kind), at_least, out=own)
        for part, own in sums.items():
            bits = np.packbits(own >= at_least, bitorder="little")
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits.tobytes()], pa.binary())], ["part", "bits"])

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    added = texts.mapInArrow(count, "part int, counts binary").repartition(min(parts, 256), "part").mapInArrow(add, "part int, bits binary")
    out = np.zeros((1 << PAIR_BITS) // 8, dtype=np.uint8)
    for r in added.collect():  # 2 ** PAIR_BITS bits in all
        out[r["part"] * _PART // 8:(r["part"] + 1) * _PART // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


# --- suffixes ----------------------------------------------------------------------------------------

WORDS = [f"w{i + 1}" for i in range(LONGEST)]
_SUFFIX = ", ".join(f"{w} long" for w in WORDS) + ", n long"


def _distinct(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows added up."""
    order = np.lexsort(keys.T[::-1])
    keys, n = keys[order], n[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    return keys[new], np.add.reduceat(n, np.flatnonzero(new)) if len(n) else n


def suffix_keys(p: Pieces, frequent: np.ndarray) -> np.ndarray:
    """Suffixes of two words or more, as rows of ``LONGEST`` hashes filled with zeros; each ends before a pair that is not frequent."""
    slot = _pair_slots(p)
    goes_on = p.follows & ((frequent[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).view(bool)
    at = np.flatnonzero(goes_on)
    keys = np.zeros((len(at), LONGEST), dtype=np.int64)
    values = p.hash.view(np.int64)
    keys[:, 0] = values[at]
    live = np.arange(len(at))
    for d in range(1, LONGEST):
        live = live[goes_on[at[live] + d - 1]]
        keys[live, d] = values[at[live] + d]
    return keys


def _buckets(keys: np.ndarray, bits: int) -> np.ndarray:
    """Route bucket of suffixes, by their two leading words."""
    return (_mix(keys[:, 0].view(np.uint64) * np.uint64(5) + keys[:, 1].view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int32)


def suffixes(texts: DataFrame, seed: int, frequent: np.ndarray, bits: int) -> DataFrame:
    """Suffixes with their counts in a chunk, packed by route bucket: ``bucket``, ``rows`` and ``packed`` (five words and a count each)."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def packed() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held)
            keys, n = _distinct(keys, np.ones(len(keys), dtype=np.int64))
            bucket = _buckets(keys, bits)
            order = np.argsort(bucket, kind="stable")
            bucket, table = bucket[order], np.column_stack([keys, n])[order]
            ends = np.flatnonzero(np.diff(bucket, append=-1)) + 1
            starts = np.concatenate([[0], ends[:-1]])
            for a, b in zip(starts, ends):
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[a:a + 1]), pa.array([b - a], pa.int64()), pa.array([table[a:b].tobytes()], pa.binary())], ["bucket", "rows", "packed"])

        for _, p in _chunks(batches, seed):
            held.append(suffix_keys(p, shared.value))
            if sum(map(len, held)) >= CHUNK_WORDS:
                yield from packed()
                held = []
        if sum(map(len, held)):
            yield from packed()

    return texts.mapInArrow(cut, "bucket int, rows long, packed binary")


def _unpacked(packed: list[bytes]) -> np.ndarray:
    """Rows of five words and a count."""
    return np.concatenate([np.frombuffer(x, np.int64) for x in packed]).reshape(-1, LONGEST + 1)


def unpacked(rows: DataFrame) -> DataFrame:
    """Packed suffixes as rows: the words ``w1`` to ``w5`` (0: none) and ``n``."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                table = _unpacked([x])
                for a in range(0, len(table), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(table[a:a + 100_000, d].copy()) for d in range(LONGEST + 1)], [*WORDS, "n"])

    return rows.select("packed").mapInArrow(unpack, _SUFFIX)


def routed(rows: DataFrame, route_rows: int) -> DataFrame:
    """``rows`` with ``deep``, the number of leading words that decide a suffix's task.

    Two words decide, and one more for every leading phrase that ``route_rows`` rows or more share, so
    that a frequent pair is split by the words after it. At most rows / route_rows phrases are listed.
    """
    total = rows.count()
    rows = rows.withColumn("deep", F.lit(2))
    for d in range(2, LONGEST):
        names = WORDS[:d]
        hot = rows.where(F.col("deep") == d).groupBy(*names).count().where(F.col("count") >= route_rows)
        hot = materialize(hot.select(*[F.col(w).alias(f"hot_{w}") for w in names]), "hot")
        listed = hot.count()
        if not listed:
            break
        same = [F.col(w) == F.col(f"hot_{w}") for w in names]
        small = F.broadcast(hot) if total // route_rows <= 100_000 else hot
        joined = rows.join(small, same, "left")
        rows = joined.withColumn("deep", F.when(F.col("hot_w1").isNotNull(), d + 1).otherwise(F.col("deep"))).select(*WORDS, "n", "deep")
    return rows


def equal_parts(keys: np.ndarray, n: np.ndarray, deep: np.ndarray, at_least: int) -> Iterator[tuple[int, int, int]]:
    """Phrases as (a row that begins with it, its length, its count), by three-way quicksort to depth ``LONGEST``.

    A part is abandoned once it holds fewer than ``at_least`` suffixes, unless other tasks have suffixes of
    the same phrase (``deep`` beyond the phrase's length): then all its parts are listed.
    """
    todo = [(np.arange(len(keys)), 0)]
    while todo:
        rows, d = todo.pop()
        whole = d + 1 if d else 2  # length of the shortest phrase that this part can still list
        if not len(rows) or (n[rows].sum() < at_least and deep[rows].max() <= whole):
            continue
        column = keys[rows, d]
        pivot = np.sort(column[[0, len(column) // 2, len(column) - 1]])[1]
        equal = column == pivot
        same = rows[equal]
        if len(same) < len(rows):
            below = column < pivot
            todo.append((rows[below], d))
            todo.append((rows[~(below | equal)], d))
        if pivot == 0:  # the suffixes end here
            continue
        if d:
            count = int(n[same].sum())
            if count >= at_least or deep[same[0]] > d + 1:
                yield int(same[0]), d + 1, count
        if d + 1 < LONGEST:
            todo.append((same, d + 1))


def _phrases(keys: np.ndarray, n: np.ndarray, deep: np.ndarray, at_least: int) -> Iterator[pa.RecordBatch]:
    keys = np.asfortranarray(keys)
    found = list(equal_parts(keys, n, deep, at_least))
    for a in range(0, len(found), 50_000):
        part = found[a:a + 50_000]
        paths = pa.array([keys[r, :size].tolist() for r, size, _ in part], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([paths, pa.array([c for *_, c in part], pa.int64())], ["p", "a"])


_PHRASE = "p array<long>, a long"


def phrase_counts(stored: DataFrame, at_least: int, route_rows: int = ROUTE_ROWS) -> DataFrame:
    """``p`` (hashes of two to five words) and ``a`` of all phrases found ``at_least`` times, from stored packed suffixes.

    A bucket is sorted by one task. Buckets of more than ``4 * route_rows`` rows are unpacked and routed by as many leading words
    as it takes; at most rows / (4 * route_rows) of them are listed.
    """
    sizes = stored.groupBy("bucket").agg(F.sum("rows").alias("rows"))
    hot = [r["bucket"] for r in sizes.where(F.col("rows") > 4 * route_rows).collect()]
    total = stored.agg(F.sum("rows").alias("rows")).first()["rows"] or 0
    usual = stored.where(~F.col("bucket").isin(hot)) if hot else stored

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
            table = _unpacked(parts)
            yield from _phrases(table[:, :LONGEST], table[:, LONGEST].copy(), np.full(len(table), 2), at_least)

        now, held = -1, []
        for b in batches:
            for bucket, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if bucket != now and held:
                    yield from done(held)
                    held = []
                now = bucket
                held.append(packed)
        if held:
            yield from done(held)

    tasks = max(-(-total // route_rows), int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = usual.select("bucket", "packed").repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(sort, _PHRASE)
    if hot:
        found = found.unionAll(_routed_phrases(materialize(unpacked(stored.where(F.col("bucket").isin(hot))), "hot-suffixes"), at_least, route_rows))
    return found.groupBy("p").agg(F.sum("a").alias("a")).where(F.col("a") >= at_least)


def _routed_phrases(rows: DataFrame, at_least: int, route_rows: int) -> DataFrame:
    """Counts of phrases of stored suffixes, in parts where several tasks have suffixes of one phrase."""
    parts = max(-(-rows.count() // route_rows), 1)
    keyed = routed(rows, route_rows)
    route = F.xxhash64(*WORDS[:2], *[F.when(F.col("deep") > d, F.col(WORDS[d])) for d in range(2, LONGEST)])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.column_stack([b.column(i).to_numpy() for i in range(LONGEST + 2)]) for b in batches if b.num_rows]
        if held:
            table = np.concatenate(held)
            del held
            yield from _phrases(table[:, :LONGEST], table[:, LONGEST].copy(), table[:, LONGEST + 1].copy(), at_least)

    slim = keyed.select(*WORDS, "n", F.col("deep").cast("long").alias("deep"))
    return slim.repartition(parts, route).mapInArrow(sort, _PHRASE)


# --- scores ------------------------------------------------------------------------------------------


def scored(phrases: DataFrame, counts: DataFrame, words: DataFrame) -> DataFrame:
    """``p``, ``a``, ``lang``, ``n``, ``l``, ``r``, ``score`` of ``phrases`` by their lowest-scoring cut; ``counts`` has all phrases."""
    single = words.where("word IS NOT NULL")
    known = counts.select("p", "a").unionByName(single.select(F.array("h").alias("p"), F.col("n").alias("a")))
    first = single.select(F.col("h").alias("first"), "lang")
    whole = words.where("word IS NULL").select("lang", "n")
    rows = phrases.withColumn("first", F.get("p", F.lit(0))).join(first, "first").join(whole, "lang").drop("first")
    cuts = rows.select("*", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("p", F.lit(1), F.col("k")), "right": F.slice("p", F.col("k") + 1, F.size("p") - F.col("k"))})
    cuts = cuts.join(known.select(F.col("p").alias("left"), F.col("a").alias("l")), "left")
    cuts = cuts.join(known.select(F.col("p").alias("right"), F.col("a").alias("r")), "right")
    # 38 digits hold the products of any counts below 10 ** 17
    score = F.expr("(1000 * cast(a AS decimal(19, 0)) * cast(n AS decimal(19, 0))) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0)))")
    best = cuts.withColumn("score", score).groupBy("p", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("p", "lang", "a", "n", "cut.l", "cut.r", "cut.score")


def uncovered(counts: DataFrame, percent: int = 100) -> DataFrame:
    """Phrases that lie in no longer phrase with at least ``percent`` of their count."""
    long = counts.where(F.size("p") > 2).select("p", "a", F.explode(F.sequence(F.lit(2), F.size("p") - 1)).alias("size"))
    parts = long.select("a", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("p") - F.col("size") + 1), lambda i: F.slice("p", i, F.col("size")))).alias("p"))
    most = parts.groupBy("p").agg(F.max("a").alias("longer"))
    return counts.join(most, "p", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, at_least: int = 100, best: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the ``best`` phrases of every language.

    A NULL text is empty and a NULL language is ``und``; repeated rows count as often as they are there. A
    language without candidates has no rows. Ties of score and count are ranked by the phrase's bytes.
    Whole texts of any length are read; other columns are not carried.
    """
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    words, seed = vocabulary(texts, at_least)
    bits = max(5, min(20, (8 * texts.rdd.getNumPartitions()).bit_length()))
    rows = materialize(suffixes(texts, seed, frequent_pairs(texts, seed, at_least), bits), "suffixes")
    counts = materialize(phrase_counts(rows, at_least), "phrases")
    kept = scored(uncovered(counts), counts, words)
    spelled = kept.select("*", F.posexplode("p").alias("at", "h")).join(words.where("word IS NOT NULL").select("h", "word"), "h")
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ")
    named = spelled.groupBy("p", "lang", "a", "n", "l", "r", "score").agg(phrase.alias("phrase"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    named = named.withColumn("part", F.pmod(F.xxhash64("p"), F.lit(RANK_PARTS)))
    named = named.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= best)
    ranked = named.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
