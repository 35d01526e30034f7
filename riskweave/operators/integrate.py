"""Bring differently coded sources into one table and remove repeated rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def harmonise(df: DataFrame, mapping: Mapping[str, Column | str], columns: Mapping[str, str]) -> DataFrame:
    """Project ``df`` onto ``columns`` (name to type); columns without a mapping are NULL."""
    unknown = set(mapping) - set(columns)
    if unknown:
        raise ValueError(f"not in the target layout: {sorted(unknown)}")

    def source(name: str) -> Column:
        expr = mapping.get(name)
        if expr is None:
            return F.lit(None)
        return F.col(expr) if isinstance(expr, str) else expr

    return df.select(*[source(name).cast(kind).alias(name) for name, kind in columns.items()])


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def dedup(df: DataFrame) -> DataFrame:
    """Distinct rows; two NULLs are equal. Copies collapse before the shuffle."""
    return df.distinct()


#: Groups of fingerprints that are marked as repeated or not; at most this many numbers are broadcast.
FINGERPRINT_GROUPS = 1 << 20


def dedup_wide(df: DataFrame) -> DataFrame:
    """Distinct rows of a table of wide rows, few of which are repeated; two NULLs are equal.

    Only 128-bit fingerprints of the rows are exchanged and counted. Rows whose group of fingerprints holds no repeated one are
    distinct and stay where they are; the others are compared as a whole. ``df`` is read three times, so
    store it first if it is costly to make.
    """
    if not df.columns:
        return df.distinct()
    cells = [F.col(f"`{c}`") for c in df.columns]
    prints = df.select(F.xxhash64(*cells).alias("a"), F.xxhash64(F.lit(1), *reversed(cells)).alias("b"))
    group = lambda h: F.pmod(h, F.lit(FINGERPRINT_GROUPS)).cast("int")
    repeated = prints.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(group(F.col("a")).alias("__repeated")).distinct()
    here = group(F.xxhash64(*cells)) == F.col("__repeated")
    small = F.broadcast(repeated)  # at most FINGERPRINT_GROUPS numbers
    return df.join(small, here, "left_anti").unionAll(df.join(small, here, "left_semi").distinct())


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, rows after, rows removed."""
    tagged = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionAll(
        after.select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return tagged.agg(
        F.sum("b").cast("bigint").alias("rows_before"),
        F.sum("a").cast("bigint").alias("rows_after"),
        (F.sum("b") - F.sum("a")).cast("bigint").alias("rows_removed"),
    )


def row_key(df: DataFrame, columns: list[str]) -> Column:
    """A 128-bit text key of the row's content, unequal for unequal rows.

    NULL fields are left out of the JSON form, so NULL differs from any value.
    On deduplicated rows it is a row identity that does not depend on position.
    """
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in columns])))
