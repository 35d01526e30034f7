"""Encoding, standardisation and feature selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.clean import long_by_type
from riskweave.operators.warehouse import with_dense_key

#: Categories of a column that still become columns of their own.
MAX_CATEGORIES = 1_000


def fit_one_hot(df: DataFrame, cols: Sequence[str], max_categories: int | None = MAX_CATEGORIES) -> dict[str, list]:
    """Sorted categories of each column, each of which becomes a column of the wide table.

    More than ``max_categories`` of them are an error, never cut off. For columns of very many
    values see :func:`sparse_one_hot`.
    """
    found: dict[str, list] = {c: [] for c in cols}
    for long in long_by_type(df, cols):
        values = long.distinct()
        rows = (values if max_categories is None else values.limit(max_categories * len(cols) + 1)).collect()
        for r in rows:
            found[r["feature"]].append(r["value"])
    for c, values in found.items():
        if max_categories is not None and len(values) > max_categories:
            raise ValueError(f"{c} has more than {max_categories} categories; it is no nominal column")
        values.sort()
    return found


def apply_one_hot(df: DataFrame, categories: Mapping[str, list], drop_first: bool = True) -> DataFrame:
    """Replace the columns by 0/1 columns ``column_value`` after all other columns.

    The columns come from the fitted categories, so they do not depend on the
    batch; an unseen value sets none of them.
    """
    dummies = [
        F.when(F.col(c) == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}")
        for c, values in categories.items() for v in values[1 if drop_first else 0:]
    ]
    return df.select(*[F.col(c) for c in df.columns if c not in categories], *dummies)


def index_categories(df: DataFrame, col: str, name: str) -> DataFrame:
    """Add ``name``: the 0-based place of the value among all values of ``col``, NULL for NULL.

    The category table is joined and may be of any size; the place is the index of a sparse encoding.
    """
    values = with_dense_key(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], "__place")
    return df.join(values.select(col, (F.col("__place") - 1).alias(name)), col, "left").select(*df.columns, name)


def sparse_one_hot(df: DataFrame, col: str) -> DataFrame:
    """Add ``{col}_index`` and ``{col}_size``: the one-hot code of a column of any number of values, smallest dropped, as a sparse vector.

    The index is the place that is 1, NULL for the smallest value and for NULL, where all places are 0.
    """
    placed = index_categories(df, col, "__index")
    size = df.agg(F.greatest(F.count_distinct(col) - 1, F.lit(0)).alias("size")).first()["size"]
    return placed.select(*df.columns, F.when(F.col("__index") > 0, F.col("__index") - 1).alias(f"{col}_index"), F.lit(int(size)).cast("long").alias(f"{col}_size"))


def cast_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def fit_zscore(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) of every column, from one pass.

    The deviation of a column whose smallest and largest value agree is exactly 0, whatever
    round-off the sums have.
    """
    row = df.agg(
        *[F.avg(c).alias(f"m|{c}") for c in cols],
        *[F.when(F.min(c) == F.max(c), F.lit(0.0)).otherwise(F.stddev_pop(c)).alias(f"s|{c}") for c in cols],
    ).first()
    return {c: (row[f"m|{c}"], row[f"s|{c}"]) for c in cols}


def collapsed_columns(stats: Mapping[str, tuple[float, float]], least: float = 1e-6) -> list[str]:
    """Columns whose fitted deviation is at most ``least``: scaling them would only enlarge noise."""
    return [c for c, (mean, std) in stats.items() if mean is None or std is None or std <= least]


def zscore_column(name: str, stats: tuple[float, float]) -> Column:
    mean, std = stats
    if mean is None or not std:
        return F.when(F.col(name).isNotNull(), F.lit(0.0))
    return (F.col(name) - F.lit(mean)) / F.lit(std)


def apply_zscore(df: DataFrame, stats: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Standardise with fitted statistics; a constant column becomes 0."""
    return df.withColumns({c: zscore_column(c, s) for c, s in stats.items()})


def fixed_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Overwrite the given columns, where present, by 0.0."""
    return df.withColumns({c: F.lit(0.0) for c in cols if c in df.columns})


def align_to(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns`` in that order: absent ones are 0, others are dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in columns])


def anova_f(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """One-way F statistic of each column against the classes of ``label``.

    One pass groups by class; what follows handles one row per class and column.
    """
    per_class = df.groupBy(F.col(label).alias("__class")).agg(
        *[F.struct(F.count(c).cast("double").alias("n"), F.avg(c).alias("m"), F.var_pop(c).alias("v")).alias(c)
          for c in cols]
    )
    long = per_class.unpivot([], list(cols), "feature", "s").select("feature", "s.n", "s.m", "s.v")
    sums = long.groupBy("feature").agg(
        F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("v")).alias("within"),
        F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("g"),
    )
    # distances of class means from the grand mean, so that a large mean cancels before squaring
    off = long.join(F.broadcast(sums.select("feature", "g")), "feature").groupBy("feature").agg(  # one row per column
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("g"), F.lit(2))).alias("between"))
    return sums.join(F.broadcast(off), "feature").select(
        "feature",
        F.try_divide(F.try_divide("between", F.col("k") - 1), F.try_divide("within", F.col("n") - F.col("k"))).alias("f_score"),
    )


def select_k_best(df: DataFrame, cols: Sequence[str], label: str, k: int = 18) -> list[str]:
    """The ``k`` columns with the highest F statistic, in their given order."""
    rows = anova_f(df, cols, label).collect()
    ranked = sorted(rows, key=lambda r: (-(r["f_score"] if r["f_score"] is not None else -1.0), cols.index(r["feature"])))
    best = {r["feature"] for r in ranked[:k]}
    return [c for c in cols if c in best]
