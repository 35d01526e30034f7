"""From raw documents to token ids in five stages.

Every stage reads what the one before wrote, takes ``(spark, docs, sf_dir)`` and returns a
DataFrame; all but the last return the columns of ``documents``. :func:`run` writes each
stage's rows as Parquet below the shared scratch folder and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bpe, decontam, langid, line_dedup, ngram_join
from riskweave.llm.common import fresh, without
from riskweave.llm.queries import vocabulary_path
from riskweave.session import materialize, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _mark() -> Column:
    """Hash of the text that, with the id, names a document."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. The text decides, its declared language and source may correct it.

    A document without any text, or in no language that the labels name, is rejected. The
    columns stay as they are, the declared language included.
    """
    key = F.struct(F.col("key").alias("id"), _mark().alias("mark"))
    evidence = langid.document_evidence(docs).withColumn("key", key)
    rejected = langid.identify(evidence, langid.fit(docs)).where(~F.col("kept")).select("key.id", "key.mark")
    return without(docs, rejected, {"id": F.col("doc_id"), "mark": _mark()})


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates; a document of which nothing is left goes.

    A template's lines stay in one document, so of copies one stays whole. ``n_chars`` follows the text.
    """
    done = line_dedup.line_dedup(docs)
    left = done.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast("long"))
    changed = {"n_chars": F.coalesce(length, F.col("n_chars")).alias("n_chars")} if "n_chars" in docs.columns else {}
    return left.select(*[changed.get(c, F.col(f"`{c}`")) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest doc_id, then of smallest hash of the text.

    A document is an id with a text: of one id, a text may go and another stay. Documents without doc_id come last in a
    group. Of repeated rows one stays.
    """
    with scratch_scope(spark):
        joined = materialize(ngram_join.ngram_join(docs), "near-duplicates", outlives=True)
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("mark") == F.col("component_mark"))
    kept = without(docs, joined.where(~first), {"doc_id": F.col("doc_id"), "mark": _mark()})
    names = fresh(docs, "_twice_id"), fresh(docs, "_twice_mark")
    twice = joined.groupBy(F.col("doc_id").alias(names[0]), F.col("mark").alias(names[1])).count().where("count > 1").drop("count")
    if twice.limit(1).count() == 0:
        return kept
    same = F.col("doc_id").eqNullSafe(F.col(names[0])) & (_mark() == F.col(names[1]))
    return kept.join(twice, same, "left_anti").union(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    return bpe.digests(bpe.round_trip(docs, vocabulary_path()))


STAGES: list[tuple[str, Stage]] = [
    ("language identification", language),
    ("line deduplication", lines),
    ("n-gram near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_free),
    ("BPE encoding", tokens),
]

#: No SQL gives these rows: the language model, the templates and the merges are no SQL expressions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


REGISTRY = {"pipeline": run}
ORACLE: dict[str, str] = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
