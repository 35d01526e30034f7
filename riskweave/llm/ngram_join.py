"""Self-join of documents by the Jaccard similarity of their 5-word shingles.

The steps, each of which keeps every document that can have a link:

1. Shingles that occur in one document only cannot be shared. A document links only if 75 %
   of its shingles occur elsewhere, so the others are done once the shared shingles are known.
   Batches of documents send one 8-byte entry per distinct shingle, packed by hash range.
2. Documents with equal sets become one; the shared shingles are counted again among the rest.
3. Shingles are ordered from rare to frequent. If two documents share at least ``o`` shingles,
   the first ``|d| - o + m`` of each share at least ``m``, for any ``m``. Every document takes
   the ``m`` with the smallest estimated cost (entries to read, pairs to verify); a pair
   has to share as many prefix shingles as the smaller of its two ``m`` says.
4. The documents of a shingle are first compared with a few of their number. Documents linked
   that way are in one component, and only pairs across components are compared further.
   Of these, a pair cannot be similar if what both have in common with the shingle's centre (the
   document most alike to those it was compared with), and what neither has in common with it, is too little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.llm.common import salted_join, small_batches
from riskweave.llm.graph import components
from riskweave.llm.shingles import mix, shingle_sets
from riskweave.session import materialize, ship_package

#: Documents and shingles that one batch holds at most (one document may hold more shingles).
BATCH_DOCS, BATCH_SHINGLES = 1 << 16, 1 << 19
#: Payload bytes that are handed to Spark at once (one row may hold more).
SEND_BYTES = 1 << 20
MATCHES = (1, 2, 3, 4, 6, 8)
#: Shingles of a document that look for a leader, and entries before a common shingle that are compared.
TRIES, LOOK_BACK = 16, 4
PACKED = "batch long, bucket long, kind int, payload binary"


def _meta(keys: list[tuple], owners: np.ndarray, hashes: np.ndarray) -> bytes:
    """Size and a 128-bit digest of every set of a batch, as one table in Arrow format."""
    n = len(keys)
    size = np.bincount(owners, minlength=n)
    low, again = np.uint64(2**32 - 1), mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    sums = [np.bincount(owners, weights=(x & low if k else x >> np.uint64(32)).astype(np.float64), minlength=n)
            for x in (hashes, again) for k in (0, 1)]
    digest = ["-".join(f"{int(x):x}" for x in row) for row in zip(size, *sums)]
    ids, marks = zip(*keys)
    made = pa.record_batch(
        [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(size, pa.int64()), pa.array(digest)], ["doc_id", "mark", "size", "digest"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, made.schema) as out:
        out.write_batch(made)
    return sink.getvalue().to_pybytes()


def _pack(batch: int, keys: list, texts: list, bits: int) -> Iterator[pa.RecordBatch]:
    hashes, owners = shingle_sets(texts)
    yield from _sent(_packed(batch, keys, hashes, owners, bits))


def _packed(batch: int, keys: list, hashes: np.ndarray, owners: np.ndarray, bits: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Rows of a batch: its documents, the first entry of every shingle, and all entries of those it has more than once."""
    yield batch, (batch + (batch >> 24)) % (1 << bits), 0, _meta(keys, owners, hashes)
    first = np.ones(len(hashes) + 1, dtype=bool)
    first[1:-1] = hashes[1:] != hashes[:-1]
    known = ~(first[:-1] & first[1:])
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int32)
    # 48 bits below the bucket's bits, and the document's place in the batch
    hashes <<= np.uint64(bits)
    hashes >>= np.uint64(16)
    hashes <<= np.uint64(16)
    hashes |= owners.astype(np.uint64)
    for kind, chosen in ((1, first[:-1]), (2, known)):
        at, values = bucket[chosen], hashes[chosen]
        cut = np.flatnonzero(np.diff(at)) + 1
        for a, b in zip([0, *cut], [*cut, len(at)]):
            if b > a:
                yield batch, int(at[a]), kind, values[a:b].tobytes()


def _sent(rows: Iterator[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of some ``SEND_BYTES``, so that neither side holds a whole batch of documents twice."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0

    def made() -> pa.RecordBatch:
        columns = zip(*held)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["batch", "bucket", "kind", "payload"])

    for row in rows:
        held.append(row)
        size += len(row[3])
        if size >= SEND_BYTES:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def _packer(bits: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        keys: list = []
        texts: list = []
        size = 0
        for rows in batches:
            for *key, text in zip(*[c.to_pylist() for c in rows.columns]):
                keys.append(key)
                texts.append(text)
                size += len(text or "") // 6
                if len(keys) == BATCH_DOCS or size >= BATCH_SHINGLES:
                    yield from _pack(number, keys, texts, bits)
                    number, keys, texts, size = number + 1, [], [], 0
        if keys:
            yield from _pack(number, keys, texts, bits)

    return pack


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket: entries of shingles that several batches have; everything else is passed on."""
    own = frame[frame["kind"] == 1]
    rest = frame[frame["kind"] != 1]
    if len(own) > 1:
        parts = [np.frombuffer(p, dtype=np.uint64) for p in own["payload"]]
        entry = np.concatenate(parts)
        where = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(entry >> np.uint64(16), kind="stable")
        value = entry[order] >> np.uint64(16)
        equal = value[1:] == value[:-1]
        shared = np.zeros(len(entry), dtype=bool)
        shared[order[1:][equal]] = True
        shared[order[:-1][equal]] = True
        found = [entry[a:b][shared[a:b]] for a, b in zip(*(lambda c: (c[:-1], c[1:]))(np.searchsorted(where, np.arange(len(parts) + 1))))]
        own = own.assign(payload=[f.tobytes() for f in found])[[len(f) > 0 for f in found]]
        rest = pd.concat([rest, own])
    return rest[["batch", "bucket", "kind", "payload"]]


def _collector(bits: int, percent: int):
    def collect(frame: pd.DataFrame) -> pd.DataFrame:
        """Of a batch: its documents, and the shared shingles of those that can have a link."""
        meta = frame[frame["kind"] == 0]["payload"].iloc[0]
        docs = pa.ipc.open_stream(meta).read_all().to_pandas(integer_object_nulls=True)
        batch = int(frame["batch"].iloc[0])
        rest = frame[frame["kind"] != 0]
        parts = [np.frombuffer(p, dtype=np.uint64) for p in rest["payload"]]
        size = docs["size"].to_numpy()
        tokens, count = [None] * len(docs), np.zeros(len(docs), dtype=np.int64)
        if parts:
            entry = np.concatenate(parts)
            bucket = np.repeat(rest["bucket"].to_numpy().astype(np.uint64), [len(p) for p in parts])
            token = (bucket << np.uint64(64 - bits)) | (entry >> np.uint64(16) << np.uint64(16) >> np.uint64(bits))
            place = (entry & np.uint64(0xFFFF)).astype(np.int32)
            del entry, bucket
            order = np.lexsort((token, place))
            token, place = token[order], place[order]
            del order
            new = np.ones(len(token), dtype=bool)
            new[1:] = (token[1:] != token[:-1]) | (place[1:] != place[:-1])
            token, place = token[new].view(np.int64), place[new]
            count = np.bincount(place, minlength=len(docs))
            ends = np.cumsum(count)
            for i in np.flatnonzero((count * 100 >= percent * size) & (size > 0)):
                tokens[i] = token[ends[i] - count[i]:ends[i]]
        return pd.DataFrame({
            "rid": (batch << 16) + np.arange(len(docs)), "doc_id": pd.array(docs["doc_id"], dtype="Int64"), "mark": docs["mark"], "size": size,
            "digest": docs["digest"], "tokens": tokens})

    return collect


def shared_shingles(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, bits: int | None = None) -> DataFrame:
    """One row per document: ``rid``, ``doc_id``, ``mark`` (hash of the text), ``size``, ``digest``, ``tokens``.

    ``tokens`` are the shingles that occur in another document, NULL where these are too few
    for any link. ``bits`` sets the number of hash ranges; by default it follows the input's partitions.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), mark.alias("mark"), F.col(text).alias("text"))
    bits = bits or max(8, min(30, (8 * rows.rdd.getNumPartitions()).bit_length()))
    packed = rows.mapInArrow(_packer(bits), PACKED)
    returned = packed.groupBy("bucket").applyInPandas(_shared, PACKED)
    return returned.groupBy("batch").applyInPandas(
        _collector(bits, percent), "rid long, doc_id long, mark long, size long, digest string, tokens array<long>")


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Shingles that sets of these sizes must share: the smallest o with 100 o >= percent (a + b - o)."""
    return F.ceil(percent * (a + b) / F.lit(100 + percent)).cast("long")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Prefix entries of documents: ``token``, ``rid``, ``size``, ``place`` (rank from rare to frequent), ``m``.

    ``sets`` has rid, size, tokens. The shingles without a second document come first in the
    order and need no entries; they only move the others back.
    """
    entries = sets.select("rid", "size", F.explode("tokens").alias("token"))
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = entries.join(lists, "token").groupBy("rid", "size").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
    at_least = F.ceil(F.col("size") * F.lit(percent / 100)).cast("int")
    ranked = ranked.withColumn("alone", (F.col("size") - F.size("t")).cast("int")).withColumn("o", at_least)
    ranked = ranked.where(F.size("t") >= F.col("o"))

    def read(m: int) -> Column:
        """Entries of other documents that a prefix for ``m`` matches makes a task read."""
        length = F.greatest(F.least(F.col("size").cast("int") - F.col("o") + m - F.col("alone"), F.size("t")), F.lit(0))
        return F.aggregate(F.slice("t", 1, length), F.lit(0).cast("long"), lambda s, x: s + x["df"] - 1)

    # a pair that shares m entries is verified once; verifying reads both sets
    costs = [F.struct((read(m) + read(m) / F.lit(m * m) * F.col("size") / 8).alias("c"), F.lit(m).alias("m")) for m in MATCHES]
    ranked = ranked.withColumn("m", F.array_min(F.array(*costs))["m"])
    length = F.least(F.col("size").cast("int") - F.col("o") + F.col("m") - F.col("alone"), F.size("t"))
    return ranked.where(length > 0).select(
        "rid", "size", "alone", "m", F.posexplode(F.slice("t", 1, length)).alias("at", "x")
    ).select("rid", "size", "m", "at", (F.col("at") + F.col("alone")).alias("place"), F.col("x.token").alias("token"))


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with ``jaccard`` and ``linked``, by exact counting of their common shingles."""
    left = sets.select(F.col("rid").alias("a"), F.col("size").alias("size_a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("rid").alias("b"), F.col("size").alias("size_b"), F.col("tokens").alias("tokens_b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("both", both)
    union = F.col("size_a") + F.col("size_b") - F.col("both")
    return joined.select("a", "b", (F.col("both") / union).alias("jaccard"), (100 * F.col("both") >= percent * union).alias("linked"))


def _usable(x: str, y: str, percent: int) -> Column:
    """Whether this shingle lies in both prefixes of a pair, and the sizes allow a link."""
    m = F.least(F.col(f"{x}.m"), F.col(f"{y}.m"))
    o = _needed(F.col(f"{x}.size"), F.col(f"{y}.size"), percent)
    fits = (o <= F.col(f"{x}.size")) & (o <= F.col(f"{y}.size"))
    for side in (x, y):
        fits = fits & (F.col(f"{side}.place") < F.col(f"{side}.size") - o + m)
    return fits


def similar_sets(sets: DataFrame, percent: int = 75) -> DataFrame:
    """Links ``a``, ``b`` that connect all documents of ``sets`` that similar pairs connect.

    ``sets`` (rid, size, tokens) has distinct sets, and is read several times. Pairs that are
    in one component already are not compared, so the links are not all similar pairs.
    """
    entries = materialize(_prefixes(sets, percent), "prefixes")
    # one leader per shingle and size class, for a document's rarest shingles: some pairs per document
    scale = F.floor(F.log(F.col("size").cast("double")) / F.lit(0.1)).cast("int")
    picked = entries.where(F.col("at") < TRIES).withColumn("scale", scale)
    leaders = picked.groupBy("token", "scale").agg(F.min_by("rid", F.xxhash64("rid", "token")).alias("b"))
    star = picked.join(leaders, ["token", "scale"]).where(F.col("rid") != F.col("b"))
    star = star.select(F.least("rid", "b").alias("a"), F.greatest("rid", "b").alias("b")).distinct()
    tried = materialize(_compared(star, sets, percent), "tried")
    first = tried.where("linked").select("a", "b")
    found = components(first)

    marked = entries.join(found.withColumnRenamed("node", "rid"), "rid", "left")
    marked = marked.withColumn("component", F.coalesce("component", "rid"))
    mixed = marked.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_ = materialize(marked.join(mixed.select("token"), "token", "left_semi"), "open")

    # the document of a shingle that is most alike to those it met is its centre; all others are compared with it
    ends = tried.select(F.col("a").alias("rid"), "jaccard").union(tried.select("b", "jaccard"))
    ends = ends.groupBy("rid").agg(F.avg("jaccard").alias("mean"), F.count(F.lit(1)).alias("met"))
    fame = F.when(F.col("met") >= 3, F.col("mean")).otherwise(F.col("mean") / 2)
    ranked = open_.join(ends, "rid", "left")
    centres = ranked.groupBy("token").agg(F.max_by("rid", F.struct(F.coalesce(fame, F.lit(0.0)), -F.col("rid"))).alias("centre"))
    placed = materialize(open_.join(centres, "token"), "centred")
    own = sets.select("rid", "size", "tokens")
    other = sets.join(placed.select(F.col("centre").alias("rid")).distinct(), "rid", "left_semi")
    other = other.select(F.col("rid").alias("centre"), F.col("size").alias("size_c"), F.col("tokens").alias("tokens_c"))
    close = salted_join(placed.select("rid", "centre").distinct().join(own, "rid"), other, ["centre"], F.xxhash64("rid"))
    close = close.withColumn("both", F.size(F.array_intersect("tokens", "tokens_c")))
    close = materialize(close.select(
        "rid", "centre", "both", (F.size("tokens") - F.col("both")).alias("rest"),
        (100 * F.col("both") >= percent * (F.col("size") + F.col("size_c") - F.col("both"))).alias("linked")), "centres")
    linked = close.where(F.col("linked") & (F.col("rid") != F.col("centre"))).select(F.col("rid").alias("a"), F.col("centre").alias("b"))
    second = materialize(first.union(linked).distinct(), "links")
    joined = components(second).withColumnRenamed("node", "rid")
    placed = placed.drop("component").join(joined, "rid", "left").withColumn("component", F.coalesce("component", "rid"))

    # two documents share no more than what both share with the centre and what neither does
    # a pair is listed at its first common shingle; others are left out if one shortly before is common, too
    order = W.partitionBy("rid").orderBy("place")
    before = F.array_compact(F.array(*[F.lag("token", i).over(order) for i in range(1, LOOK_BACK + 1)]))
    near = materialize(placed.join(close, ["rid", "centre"]).withColumn("before", before), "near")
    x, y = near.alias("x"), near.alias("y")
    most = F.least("x.both", "y.both") + F.least("x.rest", "y.rest")
    possible = ~(F.col("x.linked") & F.col("y.linked")) & (most >= _needed(F.col("x.size"), F.col("y.size"), percent))
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") < F.col("y.component"))
                   & _usable("x", "y", percent) & possible & ~F.arrays_overlap("x.before", "y.before"))
    pairs = pairs.groupBy(F.col("x.rid").alias("a"), F.col("y.rid").alias("b")).agg(F.min(F.least("x.m", "y.m")).alias("m"))
    # all common prefix shingles of documents in two components are in these lists
    prefix = near.groupBy("rid").agg(F.collect_list("token").alias("prefix"))
    pairs = pairs.join(prefix.select(F.col("rid").alias("a"), F.col("prefix").alias("prefix_a")), "a").join(
        prefix.select(F.col("rid").alias("b"), F.col("prefix").alias("prefix_b")), "b")
    pairs = pairs.where(F.size(F.array_intersect("prefix_a", "prefix_b")) >= F.col("m")).select("a", "b")
    return second.union(materialize(_compared(pairs, sets, percent).where("linked").select("a", "b"), "links"))


def ngram_join(docs: DataFrame, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``mark``, ``n_shingles``, ``component_id`` and ``component_mark`` for every row of ``docs``.

    NULL and wordless texts have empty sets and link with nothing; repeated rows link like
    any copies. A component is named by its smallest doc_id, NULL if it has none. Its first document is that
    of this id with the smallest ``mark`` (hash of the text), which ``component_mark`` is: an id may come with several texts. Other
    columns of ``docs`` are left out, so their names cannot clash.
    """
    all_docs = materialize(shared_shingles(docs, key, text, percent), "shared")
    held = all_docs.where("tokens IS NOT NULL")
    copies = held.groupBy("digest").agg(F.min("rid").alias("rep"))
    reps = held.join(copies, F.col("rid") == F.col("rep"), "left_semi").select("rid", "size", "tokens")
    again = materialize(_still_shared(reps, percent), "sets")
    links = similar_sets(again, percent)
    # a component reaches from representatives to all copies; one row per document that has any partner
    found = components(links.select("a", "b"))
    labelled = copies.join(found, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component"))
    by = F.xxhash64("rid")
    member = salted_join(held.select("rid", "doc_id", "mark", "digest", "size"), labelled, ["digest"], by)
    member = materialize(member.select("rid", "doc_id", "mark", "size", "component"), "members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("first")
    names = member.groupBy("component").agg(first)
    linked = salted_join(member, names, ["component"], by).select(
        "rid", "doc_id", "mark", F.col("size").alias("n_shingles"), F.col("first.doc_id").alias("component_id"), F.col("first.mark").alias("component_mark"))
    alone = all_docs.where("tokens IS NULL").select(
        "rid", "doc_id", "mark", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("mark").alias("component_mark"))
    return linked.unionByName(alone)


def _still_shared(reps: DataFrame, percent: int) -> DataFrame:
    """``reps`` that share enough shingles with other representatives, with those shingles."""
    entries = reps.select("rid", "size", F.explode("tokens").alias("token"))
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("token")
    kept = entries.join(lists, "token").groupBy("rid", "size").agg(F.collect_list("token").alias("tokens"))
    return kept.where(100 * F.size("tokens") >= percent * F.col("size"))
