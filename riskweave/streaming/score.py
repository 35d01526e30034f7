"""Stateless scoring of records as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskweave.operators.scoring import Artefacts, score


def read_records(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Unbounded table of the files that appear below ``path``."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def start_scoring(
    records: DataFrame, art: Artefacts, keep: Sequence[str], out: str, checkpoint: str
) -> StreamingQuery:
    """Score all records available now and append them to ``out`` as Parquet.

    The checkpoint makes a restarted query go on after the last finished batch,
    and the file sink lists each batch once, so no record is scored twice.
    """
    return (
        score(records, art, keep).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
