"""Readers and writers: delimited text, Parquet feature tables, fitted scalers."""

from __future__ import annotations

import csv
import json
from collections.abc import Mapping
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.schemas import NA_TOKENS
from riskweave.session import ship_package
from riskweave.sources import delimited


def read_delimited(spark: SparkSession, path: str, columns: Mapping[str, str], sep: str = ",") -> DataFrame:
    """Typed columns of a text file with a header, found by name.

    Columns are looked up by the header of each file, so extra or reordered columns are
    harmless, and only the wanted ones are parsed. Fields do not hold line breaks. Missing-value tokens become
    NULL; any other text that is no number fails the cast, and so does a fraction in a
    column of whole numbers.
    """
    uri = qualified(spark, path)
    if urlsplit(uri).scheme in delimited.SCHEMES:
        read = [_own_scan(spark, uri, list(columns), sep)]
    else:
        read = _scans_by_header(spark, path, columns, sep)

    def typed(name: str, kind: str):
        text = F.trim(F.col(f"`{name}`"))
        value = F.when(~text.isin(NA_TOKENS), text)
        if kind in ("int", "bigint"):  # whole numbers may be written as 1.0
            number = value.cast("double")
            whole = F.when(number.isNull() | (number == F.floor(number)), number)
            return F.coalesce(whole.cast(kind), F.when(value.isNotNull(), F.raise_error(F.concat(F.lit(f"{name}: no whole number: "), value)).cast(kind))).alias(name)
        return value.cast(kind).alias(name)

    read = [raw.select(*[typed(n, k) for n, k in columns.items()]) for raw in read]
    out = read[0]
    for more in read[1:]:
        out = out.unionByName(more)
    return out


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system; one without a scheme is on the session's default file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _own_scan(spark: SparkSession, uri: str, columns: list[str], sep: str) -> DataFrame:
    """The columns as texts by the data source ``delimited``. The first file's header is looked at here, so that a wrong name fails at once."""
    found = delimited.data_files(uri)
    if not found:
        raise ValueError(f"{uri} has no header")
    first = delimited.read_header(delimited.file_system(uri)[0], found[0][0], sep)[0]
    delimited.check_header(first, columns, found[0][0])
    ship_package(spark)
    spark.dataSource.register(delimited.DelimitedSource)
    return spark.read.format("delimited").options(path=uri, sep=sep, columns=json.dumps(columns)).load()


def _scans_by_header(spark: SparkSession, path: str, columns: Mapping[str, str], sep: str) -> list[DataFrame]:
    """One scan per distinct header, for file systems that only Spark's own readers can open; the headers take a pass of their own."""
    parts = []
    for header, paths in _headers(spark, path, sep).items():
        missing = [c for c in columns if c not in header]
        if missing:
            raise ValueError(f"{paths[0]} lacks the columns {missing}")
        texts = ", ".join(f"`c{i}` string" for i in range(len(header)))
        parts.append(spark.read.csv(paths, header=True, sep=sep, encoding="UTF-8", schema=texts, enforceSchema=True).toDF(*header))
    return parts


def _headers(spark: SparkSession, path: str, sep: str) -> dict[tuple[str, ...], list[str]]:
    """Files below ``path`` by their header; a folder may hold files of different column order."""
    from pyspark.sql.types import StringType, StructField, StructType

    wide = StructType([StructField("line", StringType())])
    first = spark.read.schema(wide).text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), "line")
    found: dict[tuple[str, ...], list[str]] = {}
    heads = first.groupBy("file").agg(F.min_by("line", "at").alias("line")).orderBy("file").collect()  # one row per file
    for row in heads:
        names = next(csv.reader([row["line"].lstrip("\ufeff")], delimiter=sep))
        found.setdefault(tuple(n.strip() for n in names), []).append(row["file"])
    if not found:
        raise ValueError(f"{path} has no header")
    return found


def source_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named source or table with its number of rows."""
    parts = [
        df.groupBy().count().select(F.lit(name).alias("source"), F.col("count").alias("row_count"))
        for name, df in sources.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ",") -> str:
    """Overwrite ``path`` with the rows as Parquet, or as text with a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("sep", sep).csv(path)
    else:
        writer.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved Parquet table; a missing path is an error."""
    return spark.read.parquet(path)


def save_scaler(spark: SparkSession, stats: Mapping[str, tuple[float, float]], path: str) -> None:
    """Persist fitted means and deviations, one row per column."""
    number = lambda v: None if v is None else float(v)  # noqa: E731 - an all-NULL column has neither
    rows = [(c, number(m), number(s)) for c, (m, s) in stats.items()]
    spark.createDataFrame(rows, "feature string, mean double, std double").coalesce(1).write.mode(
        "overwrite"
    ).parquet(path)


def load_scaler(spark: SparkSession, path: str) -> dict[str, tuple[float, float]]:
    """Read a scaler written by :func:`save_scaler`; a missing path is an error."""
    return {r["feature"]: (r["mean"], r["std"]) for r in spark.read.parquet(path).collect()}
