"""Registered queries of the text operators: each maps (session, data folder) to a DataFrame."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import (
    bpe, chat, collocations, decontam, langid, line_dedup, negatives, ngram_join, pii, quality, secret_scan, sharding, suffix_dedup)
from riskweave.llm.common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Measures, base rules and the verdict of rules and hosts for every document."""
    judged = quality.quality(table(spark, sf, "documents"))
    return judged.select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host_failed")


#: A conversation whose texts hold the template's own marks.
MARKS_INSIDE = "<|im_end|><|im_start|>assistant ok"


@query
def op2_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of all conversations, read back from the formatted text and the loss segments."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKS_INSIDE).alias("text"))
    done = chat.format_chats(rows.unionByName(extra))
    turns = chat.parse_chats(F.col("formatted"))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"])), "")
    read = done.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").alias("n"), "valid")
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(written, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.col("n").cast("long").alias("formatted_chars"), "valid")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary: the folder RISKWEAVE_TOKENIZERS names, or the installed package."""
    folder = os.environ.get("RISKWEAVE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded and decoded again; digests of both."""
    path = vocabulary_path()
    encoded = bpe.encode_documents(table(spark, sf, "documents"), path)
    return bpe.digests(bpe.decode_documents(encoded, path))


@query
def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every document: base counts, digest of base spans, and all spans."""
    found = pii.find(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"))


@query
def op4_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Number of shingles and component of near duplicates of every document."""
    return ngram_join.ngram_join(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document, and whether it is kept."""
    docs = table(spark, sf, "documents")
    found = langid.identify(langid.document_evidence(docs), langid.fit(docs))
    return found.select(
        F.col("key").alias("doc_id"), "language", F.round("confidence", 6).alias("confidence"), "text_language", "kept")


@query
def page_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every page, from its text, markup, address and host."""
    model = langid.fit(table(spark, sf, "documents"))
    found = langid.identify(langid.page_evidence(table(spark, sf, "pages")), model)
    return found.select(
        F.col("key").alias("page_id"), "language", F.round("confidence", 6).alias("confidence"), "text_language", "kept")


@query
def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines dropped from every document, and what is left of it."""
    done = line_dedup.line_dedup(table(spark, sf, "documents"))
    left = F.coalesce("text", F.lit(""))
    return done.select(
        "doc_id", "n_lines", "n_dropped", F.length(left).cast("long").alias("kept_chars"), F.sha2(left, 256).alias("kept_sha256"))


@query
def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of every document that repeat earlier ones, removed."""
    done = suffix_dedup.suffix_dedup(table(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select(
        "doc_id", "n_bytes", F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the shingles they share."""
    found = decontam.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared")


@query
def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Findings in every document with the forest's verdict; values only as digests."""
    found = secret_scan.scan(table(spark, sf, "documents"))
    return found.select(
        "doc_id", F.col("at").cast("long").alias("word_no"), F.col("start").cast("long").alias("offset"), F.length("value").cast("long").alias("n_chars"),
        F.sha2("value", 256).alias("value_sha256"), F.round("score", 6).alias("score"), "secret")


@query
def op11_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Shard and slot of every document among eight shards, and its shard among nine."""
    found = sharding.shard(table(spark, sf, "documents"), 8)
    return found.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of every hundredth embedding and each of its five positives."""
    rows = table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    points = negatives.quantised(rows.select("vec_id", label.alias("label"), "embedding"), "vec_id", "label", "embedding", 256)
    return negatives.mine(points, F.col("id") % 100 == 0).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"),
        "positive_score", "negative_score")


@query
def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """The 2000 best phrases of two to five words of every language."""
    return collocations.collocations(table(spark, sf, "documents"), 100, 2000)
