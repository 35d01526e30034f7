"""Secrets in texts: candidates by shape, and a random forest that removes false positives.

Candidates are all runs of a word, between whatever delimiters, that look like credentials. Features of a candidate
are its length, the transitions between its character classes, how much of it words of a
dictionary cover, signs of a path or address, and its neighbouring words. The forest is
fitted here to labelled findings: those of a known format are secrets; findings that are
identifiers of another known kind are not. Which format made the label is not a feature.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import computed, words
from riskweave.session import materialize

#: Formats that credentials are known by, and kinds of other identifiers (fixed values).
SECRET_FORMATS = (
    r"^(?:AKIA|ASIA)[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36,}$", r"^xox[abprs]-[A-Za-z0-9-]{10,}$", r"^AIza[A-Za-z0-9_-]{35}$",
    r"^sk_(?:live|test)_[A-Za-z0-9]{16,}$", r"^eyJ[A-Za-z0-9_-]{10,}$", r"^glpat-[A-Za-z0-9_-]{20}$",
)
HARMLESS_FORMATS = (
    r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$", r"^[0-9./:_-]+$", r"^(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}", r"^[a-z]+[0-9]{1,3}$",
    r"^[A-Za-z]+(?:[-_/][A-Za-z]+)+[0-9]{0,2}$", r"^[a-z]+[a-z0-9._-]*(?:/[a-z]+[a-z0-9._-]*)+$",
)
#: An assignment to one of these is a labelled secret if its value mixes letters and digits.
KEYWORDS = r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|private_?key|auth|credential|bearer)"
EXAMPLES = r"(?i)(?:example|sample|dummy|placeholder|changeme|test|xxxx)"
#: Every other character delimits values, so that a word may have any number of them.
_VALUE = r"[A-Za-z0-9+/_.-]{10,}={0,2}"
#: Characters of the same word that are seen on either side of a value.
CONTEXT = 64
_PART = r"[^\"'`{}<>,;()\[\]|\\]*"
_CLASS_CHANGE = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
FEATURES = ("length", "changes", "digits", "upper", "distinct", "hex", "covered", "slashes", "dots", "assigned", "keyword", "example", "plain_next")
#: Bounds of the fit: labelled findings (those of smallest hash), and words in the dictionary.
TRAIN_FINDINGS, DICTIONARY_WORDS = 20_000, 4096
MIN_WORD, MAX_WORD = 3, 8


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS) -> DataFrame:
    """The ``size`` most frequent words of 3 to 8 ASCII letters, in lower case; counts are of all documents."""
    each = docs.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^a-z]+")).alias("word"))
    each = each.where(F.octet_length("word").between(MIN_WORD, MAX_WORD))
    return each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(size).select("word")


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``_mark``, ``at`` (number of the word), ``start`` (offset in it), ``value``, ``before``, ``after``, ``word``.

    A candidate has ten characters at least, a digit and a letter. NULL text has none. ``word`` is what
    belongs to the value between quotes, brackets and commas, at most ``CONTEXT`` characters on a side.
    """
    base = docs.select("doc_id", F.xxhash64("text").alias("_mark"), F.col("text").alias("_text")).where(F.col("_text").rlike("[0-9]"))
    base = computed(base, words(F.col("_text")).alias("w"))
    each = base.select("doc_id", "_mark", "w", F.posexplode("w").alias("at", "word")).where(F.col("word").rlike("[0-9]") & (F.octet_length("word") >= 10))
    each = each.select(
        "doc_id", "_mark", "at", "word", F.concat_ws(" ", F.get("w", F.col("at") - 2), F.get("w", F.col("at") - 1), F.lit("")).alias("earlier"),
        F.coalesce(F.get("w", F.col("at") + 1), F.lit("")).alias("after"))
    each = computed(each, F.regexp_extract_all("word", F.lit(_VALUE), F.lit(0)).alias("values"), F.split("word", _VALUE, -1).alias("gaps"))
    each = each.where(F.size("values") > 0)
    lengths = F.zip_with(F.slice("gaps", F.lit(1), F.size("values")), "values", lambda g, v: F.length(g) + F.length(v))
    ends = F.aggregate(lengths, F.array(F.lit(0)), lambda done, n: F.array_append(done, F.element_at(done, -1) + n))
    each = computed(each, ends.alias("ends"))
    gap = lambda i: F.coalesce(F.get("gaps", i), F.lit(""))
    value = lambda i: F.coalesce(F.get("values", i), F.lit(""))
    found = F.transform("values", lambda v, i: F.struct(
        v.alias("value"), (F.get("ends", i) + F.length(gap(i))).alias("start"),
        F.substring(F.concat(gap(i - 1), value(i - 1), gap(i)), -CONTEXT, CONTEXT).alias("left"),
        F.substring(F.concat(gap(i + 1), value(i + 1)), 1, CONTEXT).alias("right")))
    each = each.select("doc_id", "_mark", "at", "earlier", "after", F.inline(found)).where(F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]"))
    part = F.concat(F.regexp_extract("left", _PART + "$", 0), "value", F.regexp_extract("right", "^" + _PART, 0))
    return each.select("doc_id", "_mark", "at", "start", "value", F.concat("earlier", "left").alias("before"), "after", part.alias("word"))


def _coverage(found: DataFrame, known: DataFrame) -> DataFrame:
    """``value`` and the share of its characters inside dictionary words, for distinct values."""
    low = F.lower("value")
    values = found.select("value").distinct()
    runs = values.select("value", low.alias("low"), F.explode(F.sequence(F.lit(1), F.length("value") - MIN_WORD + 1)).alias("start"))
    parts = runs.select("value", "start", F.explode(F.sequence(F.lit(MIN_WORD), F.lit(MAX_WORD))).alias("n"), "low")
    parts = parts.where(F.col("start") + F.col("n") - 1 <= F.length("low")).select("value", "start", "n", F.substring("low", F.col("start"), F.col("n")).alias("word"))
    hits = parts.where(parts["word"].rlike("^[a-z]+$")).join(F.broadcast(known), "word")  # at most DICTIONARY_WORDS rows
    inside = hits.select("value", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("at"))
    covered = inside.groupBy("value").agg(F.count_distinct("at").alias("c"))
    return covered.select("value", (F.col("c") / F.length("value")).alias("covered"))


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with one column per name in ``FEATURES``."""
    rows = found.join(_coverage(found, known), "value", "left").withColumn("covered", F.coalesce("covered", F.lit(0.0)))
    flag = lambda c: c.cast("double")
    return rows.select(
        *found.columns, F.length("value").cast("double").alias("length"), _share(_CLASS_CHANGE).alias("changes"),
        _share("[0-9]").alias("digits"), _share("[A-Z]").alias("upper"),
        (F.size(F.array_distinct(F.split("value", ""))) / F.length("value")).alias("distinct"),
        flag(F.col("value").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")).alias("hex"), "covered",
        F.regexp_count("word", F.lit("/")).cast("double").alias("slashes"),
        F.regexp_count("value", F.lit(r"\.")).cast("double").alias("dots"), flag(F.col("before").rlike(r"[=:][\s\"']*$")).alias("assigned"),
        flag(F.col("before").rlike(KEYWORDS)).alias("keyword"), flag(F.concat_ws(" ", "before", "value", "after").rlike(EXAMPLES)).alias("example"),
        flag(F.col("after").rlike(r"^[A-Za-z]+[.,]?$")).alias("plain_next"))


def labelled(found: DataFrame) -> DataFrame:
    """Findings whose kind is certain, with ``label`` 1.0 (secret) or 0.0."""
    def any_of(patterns: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for p in patterns:
            out = out | F.col("value").rlike(p)
        return out

    assigned = F.col("before").rlike(KEYWORDS + r"[A-Za-z_]*[\"'`]?\s*[=:]\s*[\"'`]?$") & F.col("value").rlike("[0-9].*[A-Za-z].*[0-9]")
    # of user:password@host the password is none of an address
    login = F.col("before").rlike(r"://[^/@\s]*:$") & F.expr("substring(word, locate(value, word) + length(value), 1) = '@'")
    address = (F.col("word").contains("@") | F.col("word").rlike(r"^[a-z]+://")) & ~login
    label = F.when(any_of(SECRET_FORMATS) | assigned, 1.0).when(any_of(HARMLESS_FORMATS) | address, 0.0)
    return found.withColumn("label", label).where("label IS NOT NULL")


def train(rows: DataFrame, most: int = TRAIN_FINDINGS, trees: int = 30, depth: int = 6) -> RandomForestClassificationModel | float:
    """Forest fitted to at most ``most`` labelled findings, those of smallest hash of value and context.

    Identical findings count once. The sample is put into one partition and sorted, so that the
    forest does not depend on the cluster. With labels of one kind only, that label is the result.
    """
    by = F.xxhash64("value", "before", "after")
    sample = rows.select("value", "before", "after", "label", *FEATURES).distinct().orderBy(by, "value", "before", "after").limit(most)
    sample = materialize(sample.coalesce(1), "findings")
    kinds = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else 1.0
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=17, subsamplingRate=0.7).fit(ready)


def scan(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Findings in ``docs``: ``doc_id``, ``_mark``, ``at``, ``start``, ``value``, ``score``, ``secret``.

    ``score`` is the forest's probability; ``secret`` says whether it is at least ``least``. One row
    per candidate, of which a word may have several; repeated rows of ``docs`` give repeated findings. Other
    columns are left out, so their names cannot clash.
    """
    known = materialize(dictionary(docs), "dictionary")
    found = materialize(candidates(docs), "candidates")
    rows = materialize(features(found, known), "features")
    model = train(labelled(rows))
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
        scored = model.transform(ready).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("doc_id", "_mark", "at", "start", "value", "score", (F.col("score") >= least).alias("secret"))
