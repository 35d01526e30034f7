"""Language identification by fusing text, declared language, address suffix and host.

The posterior of a language is proportional to
``P(text | language) P(declared | language) P(suffix | language) P(language | host)``.
The text model is a smoothed byte-trigram model per language, counted here over all labelled
documents. The other tables are counts of what the text alone says, by declared language, by
suffix and by host. A host's prior is smoothed towards that of its domain, and the domain's
towards all rows, so a host with few rows says little. ``und`` is a class of its own: a
text in which all trigrams are equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import salted_join, small_batches
from riskweave.llm.shingles import chunks
from riskweave.session import materialize, ship_package

BITS = 15
UNKNOWN = "und"
#: Pseudo-counts: of a trigram, of a table entry, and of the level above a host or domain.
TRIGRAM, ENTRY, LEVEL = 0.1, 1.0, 20.0
#: Trigrams overlap and repeat, so their evidence counts for less than their number.
WEIGHT = 0.2
SALT_BITS = 5
#: Labels that make a language; each takes 128 kB of the model.
MOST_LANGUAGES = 256
#: Prior share of texts in no known language.
UNKNOWN_SHARE = 0.001

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[48:58] = 48
_FOLD[9:14] = 32


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram at every byte (``1 << BITS`` where none begins), and where texts begin."""
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths + 3) - lengths - 3
    b = _FOLD[np.frombuffer(b"".join(t + b"\0\0\0" for t in texts) + b"\0\0", dtype=np.uint8)]
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32)
    ends = starts + lengths
    for back in (2, 1, 0, -1, -2):
        at = ends - back
        bucket[at[(at >= starts)]] = 1 << BITS
    return bucket, starts


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Trigram counts per label, added up within the task."""
    total: dict[str, np.ndarray] = {}
    for frame in batches:
        for label, group in frame.groupby("label"):
            for _, texts in chunks(group["text"].tolist()):
                bucket, _ = _trigrams(texts)
                total[label] = total.get(label, 0) + np.bincount(bucket, minlength=(1 << BITS) + 1)[: 1 << BITS]
    for label, counts in total.items():
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"label": label, "bucket": at, "n": counts[at]})


@dataclass(frozen=True)
class Model:
    """Languages, ``und`` last, and the log-probability of every trigram bucket in each."""

    languages: tuple[str, ...]
    table: np.ndarray


def primary(tag: Column) -> Column:
    """First part of a language tag in lower case; NULL for an empty one."""
    first = F.lower(F.regexp_extract(tag, r"^\s*([A-Za-z]{2,8})", 1))
    return F.when(first != "", first)


def fit(docs: DataFrame, text: str = "text", label: str = "lang", most: int = MOST_LANGUAGES) -> Model:
    """Count trigrams of all labelled documents. Every label makes a language, however few its documents; smoothing covers small counts.

    What reaches the driver is one number per language and bucket. That bounds the model: beyond ``most`` labels
    those of the fewest documents make no language.
    """
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    labelled = docs.select(primary(F.col(label)).alias("label"), F.col(text).alias("text")).where(f"label <> '{UNKNOWN}' AND text <> ''")
    named = sorted(r["label"] for r in labelled.groupBy("label").count().orderBy(F.desc("count"), "label").limit(most).collect())
    counted = labelled.where(F.col("label").isin(named)) if named else labelled.limit(0)
    sums = counted.mapInPandas(_counts, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((len(named) + 1, (1 << BITS) + 1), TRIGRAM)
    got = sums.toPandas()
    if len(got):
        table[[named.index(x) for x in got["label"]], got["bucket"]] += got["n"]
    table[-1] = 1
    table = np.log(table / table[:, :-1].sum(axis=1, keepdims=True))
    table[:, -1] = 0
    return Model((*named, UNKNOWN), table.astype(np.float32))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (key, text, declared, suffix, domain, host) with ``text`` replaced by ``loglik``.

    ``loglik`` is the weighted log-likelihood in each language, the best one being 0; NULL
    for a text without a trigram.
    """
    ship_package(rows.sparkSession)
    small_batches(rows.sparkSession)
    table = rows.sparkSession.sparkContext.broadcast(model.table)  # 128 kB a language

    @F.pandas_udf("array<double>")
    def likelihood(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list = []
            for _, group in chunks(texts.tolist()):
                bucket, starts = _trigrams(group)
                sums = np.stack([np.add.reduceat(t[bucket], starts, dtype=np.float64) for t in table.value], axis=1) * WEIGHT
                sums -= sums.max(axis=1, keepdims=True)
                out += [s if len(t) >= 3 else None for s, t in zip(sums, group)]
            yield pd.Series(out, dtype=object)

    kept = [c for c in rows.columns if c != "text"]
    return rows.select(*kept, likelihood("text").alias("loglik"))


def _vector(counts: DataFrame, key: list[str], model: Model) -> DataFrame:
    """Counts per key as an array in the order of the model's languages, pre-aggregated."""
    made = [F.count_if(F.col("said") == language).alias(f"n{i}") for i, language in enumerate(model.languages)]
    names = [f"n{i}" for i in range(len(model.languages))]
    return counts.groupBy(*key).agg(*made).select(*key, F.array(*[F.col(c).cast("double") for c in names]).alias("n"))


def _mixed(own: Column, above: Column) -> Column:
    """Shares of ``own`` counts smoothed with ``LEVEL`` rows that follow ``above``."""
    total = F.aggregate(own, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(own, above, lambda n, p: (n + LEVEL * p) / (total + LEVEL))


def _shares(table: DataFrame, model: Model) -> DataFrame:
    """From counts per value to log P(value | language), smoothed, per value."""
    k = len(model.languages)
    values = table.agg(F.count(F.lit(1)).alias("values"), *[F.sum(F.get("n", F.lit(i))).alias(f"t{i}") for i in range(k)]).first()
    total = F.array(*[F.lit(float((values[f"t{i}"] or 0) + ENTRY * (values["values"] + 1))) for i in range(k)])
    return table.withColumn("p", F.zip_with("n", total, lambda n, t: F.log((n + ENTRY) / t))).drop("n")


def identify(rows: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Language of every row: ``key``, ``language``, ``confidence``, ``text_language``, ``kept``.

    ``rows`` has key, text, declared, suffix, domain, host; any but the key may be NULL, which
    is no evidence. Without any trigram the text says nothing, and the row is ``und``. A row is
    kept if a language other than ``und`` has a posterior of at least ``least``.
    """
    languages = F.array(*[F.lit(x) for x in model.languages])
    best = F.get(languages, F.array_position(F.col("loglik"), F.array_max("loglik")).cast("int") - 1)
    base = materialize(scored(rows, model).withColumn("said", best), "langid")
    said = base.where("said IS NOT NULL")
    k = len(model.languages)

    count = said.agg(*[F.count_if(F.col("said") == x).alias(f"n{i}") for i, x in enumerate(model.languages)]).first()
    known = [count[f"n{i}"] + ENTRY for i in range(k - 1)]
    shares = [n / sum(known) * (1 - UNKNOWN_SHARE) for n in known] + [UNKNOWN_SHARE]
    everywhere = F.array(*[F.lit(float(x)) for x in shares])

    # P(declared | language) and P(suffix | language): one row per tag and suffix
    declared = _shares(_vector(said.where("declared IS NOT NULL"), ["declared"], model), model).withColumnRenamed("p", "p_declared")
    suffix = _shares(_vector(said.where("suffix IS NOT NULL"), ["suffix"], model), model).withColumnRenamed("p", "p_suffix")
    # host priors: all rows, then the domain, then the host
    hosts = _vector(said.where("host IS NOT NULL"), ["host", "domain"], model)
    domains = hosts.groupBy("domain").agg(F.array(*[F.sum(F.get("n", F.lit(i))) for i in range(k)]).alias("d"))
    domains = domains.select(F.col("domain").alias("parent"), _mixed(F.col("d"), everywhere).alias("above"))
    hosts = hosts.join(domains, F.col("domain").eqNullSafe(F.col("parent")), "left").select(
        "host", "domain", F.transform(_mixed(F.col("n"), F.coalesce("above", everywhere)), lambda p: F.log(p)).alias("p_host"))

    by = F.xxhash64("key")
    joined = salted_join(base, declared, ["declared"], by, "left", SALT_BITS)
    joined = salted_join(joined, suffix, ["suffix"], by, "left", SALT_BITS)
    named = hosts.select("host", F.coalesce("domain", F.lit("")).alias("parent"), "p_host")
    joined = salted_join(joined.withColumn("parent", F.coalesce("domain", F.lit(""))), named, ["host", "parent"], by, "left", SALT_BITS)

    nothing = F.array(*[F.lit(0.0)] * k)
    prior = F.coalesce("p_host", F.transform(everywhere, lambda p: F.log(p)))
    fused = F.col("loglik")
    for part in (prior, F.coalesce("p_declared", nothing), F.coalesce("p_suffix", nothing)):
        fused = F.zip_with(fused, part, lambda x, y: x + y)
    joined = joined.select("key", "said", fused.alias("logp"))
    top = F.array_max("logp")
    joined = joined.select(
        "key", "said", F.get(languages, F.array_position("logp", top).cast("int") - 1).alias("language"),
        (1 / F.aggregate("logp", F.lit(0.0), lambda s, x: s + F.exp(x - top))).alias("confidence"))
    sure = F.coalesce((F.col("language") != UNKNOWN) & (F.col("confidence") >= least), F.lit(False))
    return joined.select(
        "key", F.when(sure, F.col("language")).otherwise(UNKNOWN).alias("language"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.col("said").alias("text_language"), sure.alias("kept"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents as rows for :func:`identify`: the declared language is ``lang``, the host is ``source``."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").alias("key"), F.col("text"), primary(F.col("lang")).alias("declared"), none.alias("suffix"),
        none.alias("domain"), F.col("source").alias("host"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages as rows for :func:`identify`: language of the markup, suffix, domain and host of the address."""
    plain = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return pages.select(
        F.col("page_id").alias("key"), plain.alias("text"),
        primary(F.regexp_extract("html", r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)).alias("declared"),
        F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit("")).alias("suffix"),
        F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"),
        F.nullif(host, F.lit("")).alias("host"))
