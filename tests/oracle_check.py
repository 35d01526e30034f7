"""Compare registered queries with their SQL: ``python -m tests.oracle_check [folder] [query ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _kind(text: str) -> str:
    text = text.lower()
    names = {"varchar": "string", "integer": "int", "smallint": "int", "boolean": "boolean", "bool": "boolean"}
    return names.get(text, text)


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "" if value is None else str(value)


def differences(spark, con, fn, sql: str, folder: str) -> list[str]:
    """What differs between the query and its SQL; empty when they agree."""
    df = fn(spark, folder)
    got_types = {c: _kind(t) for c, t in df.dtypes}
    cols = sorted(got_types)
    got = sorted(tuple(_cell(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(sql)
    want_types = {c: _kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    out = []
    if got_types != want_types:
        out.append(f"types {set(got_types.items()) ^ set(want_types.items())}")
    if sorted(want_types) != cols:
        return out
    at = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(_cell(row[i]) for i in at) for row in rel.fetchall())
    if got != want:
        only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        out.append(f"rows {len(got)}/{len(want)}, differing {len(only_got)}/{len(only_want)}: {only_got[:2]} {only_want[:2]}")
    return out


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    import __spark_entry__ as entry
    from riskweave.session import get_session

    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle, bad = connect(folder), entry.queries(), entry.oracle_sql(), 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracle:
                found = differences(spark, con, queries[name], oracle[name], folder)
            else:
                found = [] if queries[name](spark, folder).count() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print("ok  " if not found else "FAIL", name, f"{time.time() - start:.1f}s", "" if name in oracle else "(rows only)", *found, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
