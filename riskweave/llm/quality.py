"""Quality rules of documents and of the hosts they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import computed, salted_join, words
from riskweave.session import materialize

SYMBOLS = "#*$%&|<>"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SALT_BITS = 5


def _occurrences(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are one of these ASCII ``chars``."""
    left = text
    for c in chars:
        left = F.replace(left, F.lit(c), F.lit(""))
    return (F.octet_length(text) - F.octet_length(left)).cast("long")


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``key``, ``host`` and the counts that the rules use, one row per row of ``docs``.

    NULL text counts as empty. Other columns are not carried, so their names cannot clash.
    Repeated 3-word windows are found by sorting fingerprints within the document;
    neighbours with equal fingerprints are compared word by word.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("key"), F.col(host).alias("host"), t.alias("t"))
    with_word = F.filter(F.split("t", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = computed(base, words(F.col("t")).alias("w"), with_word.alias("lines"))
    base = computed(base, F.size("w").alias("n"), F.length(F.bin(F.size("w"))).alias("bits"))
    windows = F.when(F.col("n") >= 3, F.sequence(F.lit(0), F.col("n") - 3)).otherwise(F.array().cast("array<int>"))
    low = F.expr("shiftleft(1L, bits) - 1L")

    def packed(i: Column) -> Column:
        mark = F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
        return mark.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))

    base = computed(base, F.sort_array(F.transform(windows, packed)).alias("marks"))

    def position(k: Column) -> Column:
        return F.get("marks", k).bitwiseAND(low).cast("int")

    def same(a: Column, b: Column) -> Column:
        equal = F.get("marks", a).bitwiseAND(F.bitwise_not(low)) == F.get("marks", b).bitwiseAND(F.bitwise_not(low))
        for step in range(3):
            equal = equal & (F.get("w", position(a) + step) == F.get("w", position(b) + step))
        return equal

    again = F.filter(windows, lambda k: F.coalesce(((k > 0) & same(k, k - 1)) | same(k, k + 1), F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda k: F.array(*[position(k) + s for s in range(3)]))))
    return base.select(
        "key", "host",
        F.col("n").cast("long").alias("n_words"),
        (F.length("t") - _occurrences(F.col("t"), SPACES)).cast("long").alias("word_chars"),
        _occurrences(F.col("t"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules() -> dict[str, Column]:
    """Rules whose failures are counted by host; a document must pass them, too."""
    return {
        "base": base_failed(),
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
    }


#: Documents that a prior counts as where hosts do not differ.
FLAT = 10.0


def host_rates(measured: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """One row per host and rule: documents, failures, and the failure rate shrunk by a beta prior.

    The prior of a rule is fitted to the hosts' raw rates by moments, so a host with few
    documents moves towards the usual rate. Where hosts do not differ, the prior counts as
    much as ``FLAT`` documents. A NULL host is no host and gets no row.
    """
    rules = rules or default_rules()
    counts = measured.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.count_if(c).alias(f"rule_{r}") for r, c in rules.items()]
    )
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"rule_{r}").alias("failures")) for r in rules])
    hosts = counts.select("host", "n_docs", F.inline(pairs))
    rate = F.col("failures") / F.col("n_docs")
    spread = F.greatest(F.var_pop(rate), F.lit(0.0))
    prior = hosts.groupBy("rule").agg(F.avg(rate).alias("mean"), spread.alias("spread"))
    strength = F.greatest(F.try_divide(F.col("mean") * (1 - F.col("mean")), F.col("spread")) - 1, F.lit(1.0))
    prior = prior.select("rule", "mean", F.when(F.col("spread") > 1e-12, strength).otherwise(F.lit(FLAT)).alias("strength"))
    shrunk = (F.col("failures") + F.col("mean") * F.col("strength")) / (F.col("n_docs") + F.col("strength"))
    return hosts.join(F.broadcast(prior), "rule").withColumn("rate", shrunk)  # one row per rule


def judge(measured: DataFrame, limit: float = 0.5) -> DataFrame:
    """``measured`` with ``base_failed``, ``host_failed`` and ``kept``.

    A host fails when the shrunk failure rate of any rule is above ``limit``. The few rows of
    failing hosts are repeated per salt, so that a host with a third of all documents is
    spread over ``2 ** SALT_BITS`` tasks in the join.
    """
    verdict = host_rates(measured).groupBy("host").agg(F.max("rate").alias("worst")).where(F.col("worst") > limit)
    joined = salted_join(measured, verdict, ["host"], F.xxhash64("key"), "left", SALT_BITS)
    own = F.lit(False)
    for failed in default_rules().values():
        own = own | failed
    return joined.select(
        "*", base_failed().alias("base_failed"), F.col("worst").isNotNull().alias("host_failed"),
        (~own & F.col("worst").isNull()).alias("kept"),
    ).drop("worst")


def quality(docs: DataFrame, limit: float = 0.5) -> DataFrame:
    """Measure documents, judge their hosts and join the verdicts back.

    The measures (a few numbers per document) are stored once, since both the host rates
    and the join read them.
    """
    return judge(materialize(measure(docs), "quality"), limit)
