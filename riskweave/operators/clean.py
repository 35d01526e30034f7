"""Column statistics and imputation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.quantiles import exact_quantiles

#: Values a sketch of frequent items tracks, and the best of them that are counted.
TRACKED, LISTED = 65_536, 1_024


def long_by_type(df: DataFrame, cols: Sequence[str]) -> Iterator[DataFrame]:
    """The columns as (feature, value) rows, one frame per data type, NULLs left out."""
    kinds: dict[str, list[str]] = {}
    for name, kind in df.select(*cols).dtypes:
        kinds.setdefault(kind, []).append(name)
    for names in kinds.values():
        long = df.unpivot([], names, "feature", "value") if len(names) > 1 else df.select(
            F.lit(names[0]).alias("feature"), F.col(names[0]).alias("value")
        )
        yield long.where(F.col("value").isNotNull())


def column_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Mean of every column in one pass, NULLs skipped."""
    return df.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()


def column_modes(df: DataFrame, cols: Sequence[str], tracked: int = TRACKED, listed: int = LISTED) -> dict[str, object]:
    """Most frequent value of every column; ties go to the smallest value.

    One pass keeps the frequent items of every column in a sketch of bounded size that merges across tasks. Where all values of a
    column of few values are listed, their counts are exact. For others the listed values are counted in a second pass, and the best is
    the mode for certain if it beats what any other value can have; only where it does not are all values counted.
    """
    modes: dict[str, object] = dict.fromkeys(cols)
    if not cols:
        return modes
    parts = {
        "t": lambda c: F.call_function("approx_top_k", c, F.lit(listed), F.lit(tracked)), "n": F.count, "d": F.approx_count_distinct}
    found = df.agg(*[f(F.col(f"`{c}`")).alias(f"{m}{i}") for i, c in enumerate(cols) for m, f in parts.items()]).first()
    unsure = []
    for i, c in enumerate(cols):
        n, items = found[f"n{i}"], [(r["count"], r["item"]) for r in found[f"t{i}"] if r["item"] is not None]
        if not n:
            continue
        if len(items) < listed < tracked // 8 and found[f"d{i}"] < 2 * listed and sum(k for k, _ in items) == n:
            modes[c] = _best(items)
            continue
        col = F.col(f"`{c}`")
        counted = df.where(col.isin([v for _, v in items])).groupBy(col.alias("v")).count().collect() if items else []  # at most ``listed`` rows
        exact = [(r["count"], r["v"]) for r in counted]
        # other values have at most what the sketch may lose, twice, or the last estimate of a full list
        others = max(math.ceil(7 / tracked * n), min(k for k, _ in items) if len(items) >= listed - 1 else 0)
        if exact and (sum(k for k, _ in exact) == n or max(k for k, _ in exact) > others):
            modes[c] = _best(exact)
        else:
            unsure.append(c)
    return modes | (_counted_modes(df, unsure) if unsure else {})


def _best(counts: list[tuple[int, object]]) -> object:
    most = max((n for n, _ in counts), default=0)
    return min((v for n, v in counts if n == most), default=None)


def _counted_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Modes by counting every value: one row per distinct value and task is shuffled."""
    modes: dict[str, object] = dict.fromkeys(cols)
    for long in long_by_type(df, cols):
        counts = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
        best = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))
        modes.update({r["feature"]: r["mode"] for r in best.collect()})
    return modes


def fit_impute(df: DataFrame, mean_cols: Sequence[str], mode_cols: Sequence[str]) -> dict[str, object]:
    """Fill value of each column: its mean, or its most frequent value."""
    fill: dict[str, object] = {}
    if mean_cols:
        fill.update(column_means(df, mean_cols))
    if mode_cols:
        fill.update(column_modes(df, mode_cols))
    return fill


def apply_impute(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by the fitted value of the column."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items() if v is not None}
    )


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows (feature, null_count), one per column, from one pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "feature", "null_count")


def total_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: NULL cells over all columns."""
    return null_counts(df, cols).agg(F.sum("null_count").cast("bigint").alias("null_cells"))


def describe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, quartiles interpolated and exact."""
    moments = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{n}|{c}") for c in cols for n, f in (
            ("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    ).first()
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = [
        (c, moments[f"count|{c}"], moments[f"mean|{c}"], moments[f"std|{c}"], moments[f"min|{c}"],
         *quartiles[c], moments[f"max|{c}"])
        for c in cols
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "feature string, count bigint, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double",
    )
