"""Dense surrogate keys, star schema and roll-up queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.functions.columns import flag_share
from riskweave.session import materialize

# monotonically_increasing_id() holds the row's place in its partition in the low 33 bits.
_PLACE_BITS = 33
# Copies of one row that a single task writes out.
COPY_CHUNK = 1_000_000


def number_copies(df: DataFrame, name: str) -> DataFrame:
    """Number the copies of each row from 0, which makes all rows unequal.

    Copies are counted before the shuffle; a row repeated a billion times is
    written out again in chunks spread over many tasks.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    last_chunk = F.floor((F.col("__n") - 1) / F.lit(COPY_CHUNK))
    chunks = counted.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    low = F.col("__chunk") * COPY_CHUNK
    high = F.least(low + COPY_CHUNK, F.col("__n")) - 1
    return chunks.repartition(*df.columns, "__chunk").select(*df.columns, F.explode(F.sequence(low, high)).alias(name))


def with_dense_key(df: DataFrame, order_cols: Sequence[str], name: str, unique: bool = True) -> DataFrame:
    """Add a 1-based key without gaps, in the order of ``order_cols``.

    The rows are range-partitioned and sorted once and stored with their place.
    Only one row count per partition is summed up across partitions, so no task
    sees more than its own range. ``unique`` states that ``order_cols`` tell all
    rows apart; otherwise the other columns and a copy number break ties.
    """
    columns = df.columns
    order = list(order_cols)
    if not unique:
        df = number_copies(df, "__copy")
        order += [c for c in df.columns if c not in order]
    at = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns, at.alias("__at"))
    placed = materialize(ranged, "dense-key").withColumn("__part", F.shiftright("__at", _PLACE_BITS))
    before = F.sum("__rows").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    # One row per range partition, so at most spark.sql.shuffle.partitions rows.
    offsets = (
        placed.groupBy("__part").agg(F.count("*").alias("__rows"))
        .select("__part", F.coalesce(before, F.lit(0)).alias("__offset"))
    )
    place = F.col("__at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    keyed = placed.join(F.broadcast(offsets), "__part")
    return keyed.select((F.col("__offset") + place + 1).alias(name), *columns)


def build_star(
    df: DataFrame,
    order_cols: Sequence[str],
    dims: Mapping[str, tuple[str, Sequence[str]]],
    fact: str,
    measures: Sequence[str | Column],
    flags: Sequence[str],
    unique: bool = True,
    defaults: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Split a wide table into a fact and one dimension per column group.

    ``dims`` maps a table name to its key name and columns. All tables share
    the row's dense key, so dimensions are one to one with the fact. The fact
    holds ``measures`` and ``risk_score``, the share of ``flags`` that are set.
    Columns in ``defaults`` are stored as whole numbers, 0 where missing.
    """
    wide = df.withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in defaults})
    needed = list(dict.fromkeys(
        [*order_cols, *flags, *[c for _, cols in dims.values() for c in cols], *[m for m in measures if isinstance(m, str)]]
    ))
    wide = wide.select(*(needed if all(isinstance(m, str) for m in measures) else wide.columns))
    keyed = with_dense_key(wide, order_cols, "__key", unique)
    tables = {
        table: keyed.select(F.col("__key").alias(key), *cols) for table, (key, cols) in dims.items()
    }
    tables[fact] = keyed.select(
        F.col("__key").alias("fact_id"),
        *[F.col("__key").alias(key) for key, _ in dims.values()],
        *measures,
        flag_share(flags).alias("risk_score"),
    )
    return tables


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables visible to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_star(
    tables: Mapping[str, DataFrame], path: str, keys: Mapping[str, str] | None = None, buckets: int | None = None
) -> None:
    """Drop and recreate all tables below ``path`` as Parquet.

    With ``buckets`` the tables become catalog tables bucketed by the join key
    in ``keys``, so that fact-dimension joins need no shuffle.
    """
    for name, df in tables.items():
        target = f"{path.rstrip('/')}/{name}"
        if buckets and keys:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
            # one file a bucket, not one a bucket and task
            df.repartition(buckets, keys[name]).write.mode("overwrite").bucketBy(buckets, keys[name]).sortBy(keys[name]).option(
                "path", target
            ).saveAsTable(name)
        else:
            df.write.mode("overwrite").parquet(target)


def load_star(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Read saved tables and register them as views."""
    tables = {name: spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in names}
    register_views(tables)
    return tables


def rollup_query(
    fact: DataFrame, dim: DataFrame, on: str, by: str, aggs: Mapping[str, Column], digits: int | None = None
) -> DataFrame:
    """Join the fact to one dimension and aggregate by one of its columns.

    ``digits`` rounds the averages half away from zero, as SQL ROUND does.
    """
    joined = fact.join(dim.select(on, by), on)
    out = joined.groupBy(by).agg(*[c.alias(n) for n, c in aggs.items()])
    if digits is None:
        return out
    kinds = dict(out.dtypes)
    return out.select(by, *[F.round(n, digits).alias(n) if kinds[n] == "double" else F.col(n) for n in aggs])
