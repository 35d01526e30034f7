"""Order-grain feature table, the general-purpose counterpart of the patient table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import convert, ratio_per_square, recode, round_half_even
from riskweave.operators import clean, features, integrate, warehouse
from riskweave.session import materialize, scratch_path

NUMERIC = ["totalprice", "acctbal", "n_lines", "qty", "price", "discount", "tax"]
NOMINAL = ["status", "priority", "segment"]
FLAGS = ["open_lines", "bulk", "deep_discount", "high_tax", "urgent", "rich"]
RISK_FLAGS = ["open_lines", "bulk", "deep_discount", "high_tax", "urgent"]
RULE_ITEMS = ["bulk", "deep_discount", "high_tax", "open_lines", "rich", "target", "urgent"]

FACT = "order_fact"
DIMS = {
    "dim_party": ("party_id", ["segment", "nation", "acctbal"]),
    "dim_order": ("detail_id", ["status", "priority"]),
    "dim_value": ("value_id", ["totalprice", "qty", "price"]),
}

RECORD_COLUMNS = {
    "subject": "bigint", "amount": "double", "amount_k": "double", "density": "double", "quantity": "double",
    "discount": "double", "status": "int", "priority": "int", "channel": "int", "target": "int",
}
RECORD_MEANS = ["amount", "amount_k", "density", "quantity", "discount"]
RECORD_MODES = ["status", "priority", "channel"]
STATUS_CODES = {"F": 0, "O": 1}
PRIORITY_CODES = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "5-LOW": 1}
CHANNEL_CODES = {"view": 0, "click": 1, "purchase": 2, "signup": 3}

OLAP = {
    "olap_by_segment": """
        SELECT p.segment, ROUND(AVG(f.risk_score), 4) AS avg_risk_score, COUNT(*) AS order_count,
               SUM(f.target) AS returned_count
        FROM order_fact f JOIN dim_party p ON f.party_id = p.party_id GROUP BY p.segment""",
    "olap_by_status": """
        SELECT d.status, ROUND(AVG(f.target), 4) AS return_rate, COUNT(*) AS order_count
        FROM order_fact f JOIN dim_order d ON f.detail_id = d.detail_id GROUP BY d.status""",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its line measures; orders without lines have NULLs.

    Lines are reduced per order before the join, and that shuffle's layout serves
    the join with orders as well.
    """
    flag = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").cast("double").alias("n_lines"), F.sum("l_quantity").alias("qty"),
        F.sum("l_extendedprice").alias("price"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"),
        flag(F.col("l_linestatus") == "O").alias("open_lines"), flag(F.col("l_quantity") >= 45).alias("bulk"),
        flag(F.col("l_discount") >= 0.08).alias("deep_discount"), flag(F.col("l_tax") >= 0.07).alias("high_tax"),
        F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("returned"),
    )
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    wide = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return wide.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("totalprice"),
        F.col("c_acctbal").alias("acctbal"), "n_lines", "qty", "price", "discount", "tax",
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"),
        "open_lines", "bulk", "deep_discount", "high_tax",
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0).alias("urgent"),
        F.when(F.col("c_acctbal") >= 8000, 1).otherwise(0).alias("rich"),
        F.when(F.col("returned") >= 0.5, 1).otherwise(0).alias("target"),
    )


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored copy of :func:`order_features`, for plans that read it several times."""
    return materialize(order_features(spark, sf_dir), "orders")


def clean_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imputed orders: means for measures, most frequent values for flags."""
    table = feature_table(spark, sf_dir)
    return clean.apply_impute(table, clean.fit_impute(table, NUMERIC, FLAGS))


def model_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Imputed, encoded and standardised orders with their feature columns."""
    table = clean_features(spark, sf_dir)
    encoded = features.apply_one_hot(table, features.fit_one_hot(table, NOMINAL)).drop("nation")
    scaled = features.apply_zscore(encoded, features.fit_zscore(encoded, NUMERIC))
    stored = materialize(scaled, "model")
    return stored, [c for c in stored.columns if c not in ("order_id", "target")]


def tree_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Imputed and encoded orders in their own units, which trees split like standardised ones, and their feature columns.

    Measures are rounded, so that means of equal lines are equal numbers in whatever order they were added up.
    """
    table = clean_features(spark, sf_dir)
    encoded = features.apply_one_hot(table, features.fit_one_hot(table, NOMINAL)).drop("nation")
    stored = materialize(encoded.withColumns({c: round_half_even(c, 6) for c in NUMERIC}), "trees")
    return stored, [c for c in stored.columns if c not in ("order_id", "target")]


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Fact and dimensions at order grain, registered as views."""
    tables = warehouse.build_star(
        order_features(spark, sf_dir), ["order_id"], DIMS, FACT, ["target"], RISK_FLAGS)
    warehouse.register_views(tables)
    return tables


def stored_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star as catalog tables, bucketed by the key that fact and dimensions share."""
    mark = uuid.uuid4().hex
    keys = {FACT: "fact_id", **{t: k for t, (k, _) in DIMS.items()}}
    tables = {f"{n}_{mark}": t for n, t in star(spark, sf_dir).items()}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    warehouse.save_star(tables, scratch_path(spark, "star"), {f"{n}_{mark}": k for n, k in keys.items()}, buckets)
    return {n: spark.table(f"{n}_{mark}") for n in keys}


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, orders and events in one layout; what a source lacks is NULL."""
    line_map = {
        "subject": "l_suppkey", "amount": "l_extendedprice", "amount_k": convert("l_extendedprice", 1000),
        "density": ratio_per_square(convert("l_extendedprice", 1000), "l_quantity", 10), "quantity": "l_quantity",
        "discount": "l_discount", "status": recode("l_linestatus", STATUS_CODES),
        "target": recode("l_returnflag", {"A": 0, "N": 0, "R": 1}),
    }
    order_map = {
        "subject": "o_custkey", "amount": "o_totalprice", "amount_k": convert("o_totalprice", 1000),
        "status": recode("o_orderstatus", STATUS_CODES), "priority": recode("o_orderpriority", PRIORITY_CODES),
        "target": F.when(F.col("o_orderstatus") == "P", 1).otherwise(0),
    }
    event_map = {
        "subject": "user_id", "amount": "value", "channel": recode("event_type", CHANNEL_CODES),
        "target": F.when(F.col("event_type") == "error", 1).otherwise(0),
    }
    return integrate.union_all(*[
        integrate.harmonise(load(spark, sf_dir, t), m, RECORD_COLUMNS)
        for t, m in (("lineitem", line_map), ("orders", order_map), ("events", event_map))
    ])
