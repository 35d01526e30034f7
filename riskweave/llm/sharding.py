"""Shards by jump consistent hashing (Lamping and Veach 2014), with gapless slots in every shard.

A key's walk visits growing shard numbers; it lives in the last one below the number of shards.
No ring and no table of shards is kept: the key and the number of shards decide, and the walk's
next stop says at which number of shards the key moves, always into a shard that is new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from riskweave.session import materialize

# Fixed value of the method: the multiplier of its linear congruential generator.
MULTIPLIER = 2862933555777941757
#: Stops of a walk below n shards are some ln(n) + 1 on average; longer walks go on in a second loop.
USUAL_STOPS = 48
#: Hexadecimal digits of a row's digest that form its cell; cells of a shard are numbered on their own.
CELL_DIGITS = 3
#: Copies of one row that a single task writes out.
COPY_CHUNK = 100_000

_LIMB = 21
_LOW, _TOP = (1 << _LIMB) - 1, (1 << 22) - 1


def stable_key(col: Column, kind: T.DataType) -> Column:
    """A 64-bit key: whole numbers as they are, other values by their digest, NULL as 0."""
    if isinstance(kind, T.IntegralType):
        return F.coalesce(col.cast("long"), F.lit(0).cast("long"))
    digest = F.md5(col.cast("binary") if isinstance(kind, T.BinaryType) else col.cast("string"))
    return F.coalesce(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(0).cast("long"))


def _state(k0: Column, k1: Column, k2: Column, stop: Column, after: Column) -> Column:
    return F.struct(*[c.cast("long").alias(n) for n, c in (("k0", k0), ("k1", k1), ("k2", k2), ("stop", stop), ("after", after))])


def _limbs(key: Column) -> list[Column]:
    """The unsigned key as numbers of 21, 21 and 22 bits, lowest first."""
    return [key.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(key, _LIMB).bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(key, 2 * _LIMB)]


def _moved(s: Column) -> Column:
    """The walk one stop on. Products modulo 2^64 are taken by limbs, so that no long overflows."""
    m0, m1, m2 = MULTIPLIER & _LOW, (MULTIPLIER >> _LIMB) & _LOW, MULTIPLIER >> (2 * _LIMB)
    p0 = s["k0"] * F.lit(m0) + F.lit(1)
    p1 = s["k0"] * F.lit(m1) + s["k1"] * F.lit(m0) + F.shiftright(p0, _LIMB)
    p3 = (s["k1"] * F.lit(m2) + s["k2"] * F.lit(m1)).bitwiseAND(F.lit(1))  # of the next limb, only bit 63 is left
    p2 = s["k0"] * F.lit(m2) + s["k1"] * F.lit(m1) + s["k2"] * F.lit(m0) + F.shiftright(p1, _LIMB) + F.shiftleft(p3, _LIMB)
    k0, k1, k2 = p0.bitwiseAND(F.lit(_LOW)), p1.bitwiseAND(F.lit(_LOW)), p2.bitwiseAND(F.lit(_TOP))
    high = F.shiftleft(k2, 9) + F.shiftright(k1, 12)  # the generator's upper 31 bits
    after = (s["after"] + 1).cast("double") * (F.lit(float(1 << 31)) / (high + 1).cast("double"))
    return _state(k0, k1, k2, s["after"], after.cast("long"))


def jump(key: Column, shards: int) -> Column:
    """``stop`` (the shard of ``key`` among ``shards``) and ``after`` (the shard it moves to when there are more than that many)."""
    if shards < 1:
        raise ValueError("there must be a shard")

    def walk(start: Column, stops: int) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(stops)), start, lambda s, _: F.when(s["after"] < shards, _moved(s)).otherwise(s))

    done = walk(_state(*_limbs(key), F.lit(-1), F.lit(0)), min(shards, USUAL_STOPS))
    if shards > USUAL_STOPS:  # every stop is higher than the one before, so there are at most as many as shards
        done = F.when(done["after"] < shards, walk(done, shards - USUAL_STOPS)).otherwise(done)
    return F.struct(done["stop"].cast("int").alias("stop"), done["after"].alias("after"))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``shard`` and ``grown_shard`` (with one shard more) of every row.

    A projection: nothing is shuffled. Rows of one key share a shard. A NULL text has no bytes, so
    size 1 and checksum 0; a NULL key goes where 0 goes. Other columns are not carried.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    at = jump(stable_key(F.col(key), docs.schema[key].dataType), shards)
    rows = docs.select(
        F.col(key).alias("key"), (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
        F.explode(F.array(at)).alias("at"))  # a generator keeps the walk from being repeated for every use
    return rows.select(
        "key", "size", "text_crc32", F.col("at.stop").alias("shard"),
        F.when(F.col("at.after") == shards, F.lit(shards)).otherwise(F.col("at.stop")).alias("grown_shard"))


def numbered(rows: DataFrame, digits: int = CELL_DIGITS, chunk: int = COPY_CHUNK) -> DataFrame:
    """``rows`` with ``slot``, counted from 0 without gaps in every ``shard``, in the order of a digest of the row.

    Equal rows are counted before they are shuffled and written out in chunks, each in a place of
    its own. Shards are cut into cells by the digest, and only their sizes are summed up across cells, so no
    task sees a whole shard. Repeated rows have slots of their own.
    """
    names = rows.columns
    copies = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    chunks = copies.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk))).alias("_chunk"))
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names], F.col("_chunk").cast("string")))
    chunks = chunks.select(
        *names, "_chunk", F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_chunk") * chunk).alias("_n"), digest.alias("_digest"))
    stored = materialize(chunks.withColumn("_cell", F.substring("_digest", 1, digits)), "shard-rows")

    cells = stored.groupBy("shard", "_cell").agg(F.sum("_n").alias("_size"))  # at most 16 ** digits rows a shard
    before = W.partitionBy("shard").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("shard", "_cell", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("shard", "_cell").orderBy("_digest", *names, "_chunk").rowsBetween(W.unboundedPreceding, -1)
    placed = stored.withColumn("_place", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    first = F.col("_offset") + F.col("_place")
    return placed.join(cells, ["shard", "_cell"]).select(*names, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("slot"))


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`assign` with ``slot``: where every row of ``docs`` goes."""
    return numbered(assign(docs, shards, key, text))


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """Write whole rows into folders ``shard=0`` and so on, without a shuffle. A column ``shard`` of ``docs`` is replaced."""
    at = jump(stable_key(F.col(key), docs.schema[key].dataType), shards)
    docs.withColumn("shard", at["stop"]).write.partitionBy("shard").parquet(path)
