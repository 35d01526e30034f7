import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm import sharding


def jump(key, shards):
    """The published walk, in whole numbers of any size."""
    key, stop, after = key % 2**64, -1, 0
    while after < shards:
        stop, key = after, (key * sharding.MULTIPLIER + 1) % 2**64
        after = int((stop + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return stop


def test_jump_follows_the_walk(spark):
    r = random.Random(1)
    keys = [0, 1, -1, 2**63 - 1, -(2**63)] + [r.randrange(-(2**63), 2**63) for _ in range(300)] + list(range(300))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 1000):
        got = df.select("k", sharding.jump(F.col("k"), n)["stop"].alias("s")).collect()
        assert [x["s"] for x in got] == [jump(x["k"], n) for x in got], n
    with pytest.raises(ValueError):
        sharding.jump(F.col("k"), 0)


def test_long_walks_go_on_in_the_second_loop(spark, monkeypatch):
    monkeypatch.setattr(sharding, "USUAL_STOPS", 2)
    got = spark.range(200).select("id", sharding.jump(F.col("id"), 50)["stop"].alias("s")).collect()
    assert [x["s"] for x in got] == [jump(x["id"], 50) for x in got]


def test_shards_are_even_and_grow_only_into_the_new_one(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = sharding.assign(rows, 8).groupBy("shard", "grown_shard").count().collect()
    size, moved = Counter(), 0
    for x in got:
        size[x["shard"]] += x["count"]
        if x["shard"] != x["grown_shard"]:
            assert x["grown_shard"] == 8
            moved += x["count"]
    assert set(size) == set(range(8)) and max(size.values()) < 1.08 * 2500 and min(size.values()) > 0.92 * 2500
    assert 0.9 < moved / (20_000 / 9) < 1.1


def test_rows_sizes_and_slots(make):
    r = random.Random(2)
    rows = [(i, r.choice([None, "", "é" * i, "same", "x" * 50_000])) for i in range(200)]
    rows += [(7, "copy")] * 250 + [(None, "n"), (None, None), (None, None)] + [(7, f"other {i}") for i in range(50)]
    docs = make(rows).withColumns({c: F.lit(1) for c in ("shard", "slot", "size", "key", "_n", "_digest", "law")})
    assigned = sharding.assign(docs, 8)
    got = sharding.numbered(assigned, digits=1, chunk=100).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump(i or 0, 8), jump(i or 0, 9)) for i, t in rows)
    assert Counter((x["key"], x["size"], x["text_crc32"], x["shard"], x["grown_shard"]) for x in got) == want
    for s in range(8):
        slots = sorted(x["slot"] for x in got if x["shard"] == s)
        assert slots == list(range(len(slots)))
    again = sharding.shard(docs.repartition(7), 8).collect()
    order = lambda found: Counter((x["key"], x["size"], x["text_crc32"], x["slot"]) for x in found)
    assert order(again) == order(sharding.shard(docs, 8).collect())


def test_empty_tables_other_keys_and_written_shards(spark, make, tmp_path):
    assert sharding.shard(make([]), 8).count() == 0
    names = spark.createDataFrame([("a", "t"), ("b", None), (None, "u"), ("a", "v")], "doc_id string, text string")
    got = {(x["key"], x["shard"]) for x in sharding.shard(names, 4).collect()}
    assert len({k for k, _ in got}) == len(got) == 3 and (None, jump(0, 4)) in got
    assert sharding.stable_key(F.lit(1), T.IntegerType()) is not None
    sharding.write_shards(make([(i, "t") for i in range(40)]), str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s")).select("doc_id", "text", "shard").collect()
    assert sorted((x["doc_id"], x["shard"]) for x in back) == [(i, jump(i, 4)) for i in range(40)]
