import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskweave.operators import warehouse
from riskweave.plans.queries import REGISTRY

DIMS = {"dim_a": ("a_id", ["age", "gender"]), "dim_b": ("b_id", ["smoke"])}


def test_dense_key_follows_order_for_any_partitioning(spark):
    base = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"))
    for parts in (1, 7):
        rows = warehouse.with_dense_key(base.repartition(parts), ["k"], "key").orderBy("key").collect()
        assert [r["key"] for r in rows] == list(range(1, 1001))
        assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_dense_key_numbers_copies(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "COPY_CHUNK", 16)
    data = [("hot", 1)] * 100 + [("b", i % 5) for i in range(50)] + [(None, 2)] * 3
    out = warehouse.with_dense_key(spark.createDataFrame(data, "t string, v int"), ["t"], "key", unique=False).collect()
    assert sorted(r["key"] for r in out) == list(range(1, 154))
    assert Counter((r["t"], r["v"]) for r in out) == Counter(data)


@pytest.fixture(scope="module")
def star(spark):
    data = [(i, 20.0 + i, i % 2, None if i == 3 else i % 3 % 2, 1, i % 2) for i in range(12)]
    df = spark.createDataFrame(data, "id long, age double, gender int, smoke int, stroke int, target int")
    return warehouse.build_star(df, ["id"], DIMS, "fact", ["target"], ["smoke", "stroke"], defaults=["smoke"])


def test_star_tables(star):
    assert star["fact"].columns == ["fact_id", "a_id", "b_id", "target", "risk_score"]
    assert star["dim_a"].columns == ["a_id", "age", "gender"]
    assert {n: t.count() for n, t in star.items()} == {"dim_a": 12, "dim_b": 12, "fact": 12}
    assert star["dim_b"].where("b_id = 4").first()["smoke"] == 0
    assert {r["risk_score"] for r in star["fact"].collect()} == {0.5, 1.0}


def test_rollup_and_sql_agree(spark, star):
    warehouse.register_views(star)
    sql = spark.sql("SELECT gender, ROUND(AVG(risk_score), 4) s, COUNT(*) n FROM fact JOIN dim_a USING (a_id) GROUP BY gender")
    api = warehouse.rollup_query(star["fact"], star["dim_a"], "a_id", "gender", {"s": F.avg("risk_score"), "n": F.count("*")}, 4)
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, api.collect()))


def test_save_load_and_recreate(spark, star, tmp_path):
    for _ in range(2):
        warehouse.save_star(star, str(tmp_path))
    loaded = warehouse.load_star(spark, str(tmp_path), list(star))
    assert sorted(map(tuple, loaded["fact"].collect())) == sorted(map(tuple, star["fact"].collect()))


def test_bucketed_tables_join_without_shuffle(spark, star, tmp_path):
    tables = {f"bucketed_{n}": t for n, t in star.items()}
    keys = {"bucketed_fact": "a_id", "bucketed_dim_a": "a_id", "bucketed_dim_b": "b_id"}
    warehouse.save_star(tables, str(tmp_path), keys, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_fact").join(spark.table("bucketed_dim_a"), "a_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count() == 12 and "Exchange hashpartitioning" not in plan


def test_stored_rollups_exchange_nothing_below_the_aggregate(spark):
    folder = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip(f"no tables in {folder}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rolled = REGISTRY["olap_stored"](spark, folder)
        plan = rolled._jdf.queryExecution().executedPlan().toString()
        assert rolled.count() > 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) == ["nation", "priority", "segment", "status"]
    assert plan.count("SortMergeJoin") == 4
