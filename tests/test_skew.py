"""Queries agree with their SQL when a third of the rows share a key and values are missing."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import TABLES, connect, differences

SOURCE = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

# Replacements per table: a hot key or value for a third of the rows, NULLs for some.
CHANGES = {
    "lineitem": {
        "l_orderkey": "CASE WHEN n % 3 = 0 THEN 7 ELSE l_orderkey END",
        "l_partkey": "CASE WHEN n % 3 = 1 THEN 5 ELSE l_partkey END",
        "l_quantity": "CASE WHEN n % 17 = 0 THEN NULL WHEN n % 3 = 2 THEN 20 ELSE l_quantity END",
        "l_extendedprice": "CASE WHEN n % 19 = 0 THEN NULL ELSE l_extendedprice END",
        "l_discount": "CASE WHEN n % 23 = 0 THEN NULL ELSE l_discount END",
        "l_returnflag": "CASE WHEN n % 29 = 0 THEN NULL ELSE l_returnflag END",
    },
    "orders": {
        "o_custkey": "CASE WHEN n % 3 = 0 THEN 1 ELSE o_custkey END",
        "o_orderstatus": "CASE WHEN n % 31 = 0 THEN NULL ELSE o_orderstatus END",
        "o_totalprice": "CASE WHEN n % 37 = 0 THEN NULL ELSE o_totalprice END",
        "o_orderpriority": "CASE WHEN n % 41 = 0 THEN NULL ELSE o_orderpriority END",
    },
    "events": {
        "user_id": "CASE WHEN n % 3 = 0 THEN 1 ELSE user_id END",
        "ts": "CASE WHEN n % 3 = 0 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE ts END",
        "event_type": "CASE WHEN n % 43 = 0 THEN NULL ELSE event_type END",
        "value": "CASE WHEN n % 47 = 0 THEN NULL WHEN n % 3 = 1 THEN 33 ELSE value END",
    },
    "documents": {"text": "CASE WHEN n % 3 = 0 THEN 'the same copy' ELSE text END"},
}

NAMES = (
    "integrate_sources dedup_rows dedup_documents dedup_stats null_audit null_total_after_impute impute_mean impute_mode "
    "describe_numeric one_hot_drop_first zscore anova_f star_fact olap_by_status split_stratified class_balance regress_multi "
    "cluster_labels itemsets_events itemsets_growth itemsets_parts itemsets_flags rules_top10 risk_bands_right band_summary "
    "validate_inputs yes_no_tokens drift_flags score_fixed top_contrib outlier_threshold"
).split()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    if not os.path.isdir(SOURCE):
        pytest.skip(f"no tables in {SOURCE}")
    out, con = tmp_path_factory.mktemp("skewed"), connect(SOURCE)
    for table in TABLES:
        changes = ", ".join(f"{expr} AS {c}" for c, expr in CHANGES.get(table, {}).items())
        replace = f"REPLACE ({changes})" if changes else ""
        con.execute(
            f"COPY (SELECT * EXCLUDE n {replace} FROM (SELECT *, row_number() OVER () AS n FROM {table})) "
            f"TO '{out}/{table}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_tables(spark, folder, name):
    assert differences(spark, connect(folder), entry.queries()[name], entry.oracle_sql()[name], folder) == []
