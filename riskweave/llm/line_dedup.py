"""Recurring lines: a log-template tree over all documents, and what remains of their texts.

The tree has a fixed depth: number of tokens, then the leading tokens. Tokens with a digit count
as variable fields from the start, unless they are over a quarter of the line. Below a leaf, a token that fewer documents have at its
place than the line's other tokens is a variable field, too; the rest of the line is its template.
A line that fits no recurring template exactly joins the one it resembles. All of that is counting and joining by
key, so that the result depends neither on the order of lines nor on their distribution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import computed, salted_join, words
from riskweave.session import materialize, scratch_scope

FIELD = "<*>"
#: A whole token that has a digit; possessive, so that a long token is read once.
_NUMBER = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def _identity(docs: DataFrame) -> DataFrame:
    """Rows with equal doc_id and text are one document; NULL text counts as empty."""
    return docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_mark", F.xxhash64("_text"))


def parse(docs: DataFrame, leading: int = 3, alike: float = 0.75) -> DataFrame:
    """One row per line with a token: document, line number, leaf, hash and text of the masked line.

    A line of which less than a share ``alike`` would be left stays unmasked, so that it recurs
    only with its numbers.
    """
    lines = _identity(docs.select("doc_id", "text")).select("doc_id", "_mark", F.posexplode(F.split("_text", "\n", -1)).alias("line_no", "line"))
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", _NUMBER, FIELD)).otherwise(F.col("line"))
    lines = computed(lines, words(masked).alias("tokens")).where(F.size("tokens") > 0)
    kept = F.size(F.filter("tokens", lambda t: t != FIELD))
    tokens = F.when(kept >= F.lit(alike) * F.size("tokens"), F.col("tokens")).otherwise(words(F.col("line")))
    lines = computed(lines, tokens.alias("chosen")).select("doc_id", "_mark", "line_no", F.col("chosen").alias("tokens"))
    lines = lines.select("doc_id", "_mark", "line_no", F.size("tokens").alias("n_tokens"), F.slice("tokens", 1, leading).alias("lead"), F.array_join("tokens", " ").alias("masked"))
    return lines.select(
        "doc_id", "_mark", "line_no", F.xxhash64("n_tokens", "lead").alias("leaf"), F.xxhash64("masked").alias("line"), "n_tokens", "masked")


def _tokens(rows: DataFrame) -> DataFrame:
    return rows.select("leaf", "line", "n_tokens", "n_docs", F.posexplode(F.split("masked", " ", -1)).alias("place", "token"))


def templates(lines: DataFrame, min_docs: int = 5, alike: float = 0.75) -> DataFrame:
    """``leaf``, ``line``, ``template`` for every masked line that has a recurring template.

    Of a line's tokens the share ``alike`` that most documents have at their place below the leaf is
    constant. Of the others a token is a variable field if less than half as many documents have it as
    have the rarest of those. Tokens are compared with those of their own line, so that the size of the
    table does not matter. A template recurs if ``min_docs`` documents have it. A line that has no recurring template takes the most frequent one below its leaf
    that agrees with it in a share ``alike`` of the tokens.
    """
    per_doc = lines.select("leaf", "line", "doc_id", "_mark").distinct()
    counts = materialize(per_doc.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n_docs")), "line-counts")
    exact = counts.where(F.col("n_docs") >= min_docs).select("leaf", "line", F.col("line").alias("template"))
    # leaves with enough documents and more than one line
    open_ = counts.groupBy("leaf").agg(F.sum("n_docs").alias("docs"), F.count(F.lit(1)).alias("n_lines"))
    open_ = open_.where((F.col("docs") >= min_docs) & (F.col("n_lines") > 1)).select("leaf")
    texts = lines.select("leaf", "line", "n_tokens", "masked").join(open_, "leaf", "left_semi")
    texts = texts.groupBy("leaf", "line").agg(F.first("n_tokens").alias("n_tokens"), F.first("masked").alias("masked"))
    texts = materialize(texts.join(counts, ["leaf", "line"]), "open-lines", codec="zstd")

    tokens = _tokens(texts)
    support = tokens.where(F.col("token") != FIELD).groupBy("leaf", "place", "token").agg(F.sum("n_docs").alias("docs")).where(F.col("docs") >= min_docs)
    cell = F.struct("place", "token", F.coalesce("docs", F.lit(0)).alias("docs"))
    shown = tokens.join(support, ["leaf", "place", "token"], "left").groupBy("leaf", "line", "n_tokens", "n_docs").agg(
        F.sort_array(F.collect_list(cell)).alias("cells"), F.count("docs").alias("n_known"))
    # a line that agrees with a template has at least so many of its constant tokens
    shown = shown.where(F.col("n_known") >= (2 * alike - 1) * F.col("n_tokens"))
    ranked = F.sort_array(F.transform("cells", lambda c: c["docs"]), asc=False)
    shown = computed(shown, F.get(ranked, F.ceil(alike * F.col("n_tokens")).cast("int") - 1).alias("least"))
    shown = shown.select(
        "leaf", "line", "n_tokens", "n_docs", "least", F.transform("cells", lambda c: c["token"]).alias("words"),
        F.transform("cells", lambda c: F.when(c["docs"] >= F.greatest(F.col("least") / 2, F.lit(min_docs)), c["token"]).otherwise(FIELD)).alias("tokens"))
    shown = materialize(shown.withColumn("template", F.xxhash64(F.lit("general"), F.array_join("tokens", " "))), "templates", codec="zstd")
    general = shown.where(F.col("least") >= min_docs)
    recurring = general.groupBy("leaf", "template").agg(F.sum("n_docs").alias("n_docs"), F.first("tokens").alias("tokens")).where(F.col("n_docs") >= min_docs)
    recurring = materialize(recurring, "recurring", codec="zstd")
    fitting = general.join(recurring.select("leaf", "template"), ["leaf", "template"]).select("leaf", "line", "template")

    left = shown.join(fitting.select("leaf", "line"), ["leaf", "line"], "left_anti").select("leaf", "line", F.col("words").alias("tokens"))
    found = fitting.unionByName(_alike(left, recurring, support, alike))
    return found.unionByName(exact.join(found.select("leaf", "line"), ["leaf", "line"], "left_anti"))


def _alike(left: DataFrame, known: DataFrame, support: DataFrame, alike: float) -> DataFrame:
    """``leaf``, ``line``, ``template`` for all lines that agree with a known template in a share ``alike`` of the tokens.

    If ``d`` tokens may differ, a line that agrees has one at least of any ``d + 1`` constants of the
    template. Those that the fewest documents have are the template's keys, so no pair is missed; the
    pairs are verified. The most frequent template of a leaf is compared with all its lines before. Rows of a key that many lines have are spread over tasks.
    """
    n = F.size("tokens")
    may_differ = (n - F.ceil(F.lit(alike) * n)).cast("int")
    equal = F.size(F.filter(F.zip_with("tokens", "pattern", lambda a, b: (a == b) | (b == FIELD)), lambda x: x))
    agrees = (n == F.size("pattern")) & (equal >= F.lit(alike) * n)
    known = known.select("leaf", "template", F.col("n_docs").alias("support"), F.col("tokens").alias("pattern"))
    # most lines agree with the most frequent template of their leaf, and no other would be taken before it
    top = known.groupBy("leaf").agg(F.max_by(F.struct("template", "pattern"), F.struct("support", "template")).alias("top")).select("leaf", "top.*")
    led = materialize(left.join(top, "leaf").where(agrees).select("leaf", "line", "template"), "led")
    left = left.join(led.select("leaf", "line"), ["leaf", "line"], "left_anti")

    cells = F.sort_array(F.collect_list(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "place", "token")))
    numbered = known.select("leaf", "template", F.size("pattern").alias("n"), F.posexplode("pattern").alias("place", "token"))
    keys = numbered.where(F.col("token") != FIELD).join(support, ["leaf", "place", "token"])
    keys = keys.groupBy("leaf", "template", "n").agg(cells.alias("cells"))
    d = (F.col("n") - F.ceil(F.lit(alike) * F.col("n"))).cast("int")
    keys = keys.select("leaf", "template", F.inline(F.slice("cells", F.lit(1), d + 1)))
    key = F.xxhash64("leaf", "place", "token").alias("key")
    keys = keys.groupBy(key).agg(F.collect_set(F.struct("leaf", "template")).alias("templates"))
    rows = left.join(known.select("leaf"), "leaf", "left_semi").select("leaf", "line", may_differ.alias("d"), F.posexplode("tokens").alias("place", "token"))
    rows = rows.join(support, ["leaf", "place", "token"], "left").groupBy("leaf", "line", "d").agg(cells.alias("cells"))
    # in the order of keys, the first token in common is among these: at most d differ and at most d are fields
    rows = rows.select("leaf", "line", F.inline(F.slice("cells", F.lit(1), 2 * F.col("d") + 1))).where("docs > 0").select("leaf", "line", key)
    pairs = salted_join(rows, keys, ["key"], F.col("line")).select("leaf", "line", F.inline("templates").alias("of_leaf", "template"))
    pairs = pairs.where(F.col("leaf") == F.col("of_leaf")).select("leaf", "line", "template").distinct()
    near = pairs.join(known, ["leaf", "template"]).join(left, ["leaf", "line"]).where(agrees)
    near = near.groupBy("leaf", "line").agg(F.max_by("template", F.struct("support", "template")).alias("template"))
    return led.unionByName(near)


def recurring_lines(docs: DataFrame, min_docs: int = 5, alike: float = 0.75, leading: int = 3) -> DataFrame:
    """Lines to drop: ``doc_id``, ``_mark`` (hash of the text), ``drops`` (line numbers from 0).

    A template keeps its lines in one document, the one with the smallest doc_id (and text hash),
    so that of a passage that all its documents have something stays.
    """
    who = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_mark")
    with scratch_scope(docs.sparkSession):
        lines = materialize(parse(docs, leading, alike), "lines", codec="zstd")
        known = materialize(templates(lines, min_docs, alike), "line-templates")
        placed = materialize(salted_join(
            lines.select("doc_id", "_mark", "line_no", "leaf", "line"), known, ["leaf", "line"], F.xxhash64("doc_id", "_mark")), "placed", outlives=True)
    first = placed.groupBy("leaf", "template").agg(F.min(who).alias("first"), F.count_distinct(F.xxhash64("doc_id", "_mark")).alias("n"))
    first = first.where(F.col("n") >= min_docs).select("leaf", "template", "first")
    drops = salted_join(placed, first, ["leaf", "template"], F.xxhash64("doc_id", "_mark")).where(~who.eqNullSafe(F.col("first")))
    return drops.groupBy("doc_id", "_mark").agg(F.collect_set("line_no").alias("drops"))


def without_lines(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """All columns of ``docs`` with their dropped lines cut from ``text``, and the numbers of lines.

    Added columns: ``n_lines``, ``n_dropped``. Documents without a dropped line are unchanged,
    NULL text included.
    """
    given = docs.columns
    kept = [c for c in given if c not in ("n_lines", "n_dropped")]
    # the caller's columns travel in a struct, where no name can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in given]).alias("given"), "doc_id", F.coalesce("text", F.lit("")).alias("whole"))
    rows = rows.withColumn("mark", F.xxhash64("whole"))
    found = drops.select(F.col("doc_id").alias("gone_id"), F.col("_mark").alias("gone_mark"), "drops")
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark")), "left")
    rows = computed(rows, F.when(F.col("drops").isNotNull(), F.split("whole", "\n", -1)).alias("lines"))
    # what stays is a difference of hashed sets: time grows with the lines, not with lines times drops
    numbers = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    rows = computed(rows, F.when(F.col("drops").isNotNull(), numbers).alias("numbers"))
    left = F.array_join(F.transform("numbers", lambda i: F.get("lines", i)), "\n")
    text = F.when(F.col("drops").isNull(), F.col("given.text")).otherwise(left)
    n_lines = F.octet_length("whole") - F.octet_length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1
    return rows.select(
        *[text.alias("text") if c == "text" else F.col(f"given.`{c}`").alias(c) for c in kept],
        n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"))


def line_dedup(docs: DataFrame, min_docs: int = 5, alike: float = 0.75, leading: int = 3) -> DataFrame:
    """``docs`` without lines of templates that recur in at least ``min_docs`` documents.

    Repeated rows are one document. A template's lines stay in the first document. Columns
    named ``n_lines`` and ``n_dropped`` are replaced by the counts.
    """
    return without_lines(docs, recurring_lines(docs, min_docs, alike, leading))
