"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import materialize

#: What separates words: the six ASCII white-space characters. Everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other letters untouched."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def computed(df: DataFrame, *cols: Column) -> DataFrame:
    """``df`` with columns that are evaluated once per row.

    Projections may be merged, which would evaluate an array again for every element a
    lambda looks up. A generator of one row keeps them apart and is compiled like a projection.
    """
    return df.select("*", F.inline(F.array(F.struct(*cols))))


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], salt_by: Column, how: str = "inner", bits: int = 4) -> DataFrame:
    """Join in which rows of ``big`` with one key are spread over ``2 ** bits`` tasks by ``salt_by``.

    ``small`` has one row per key and is repeated per salt; it may be of any size.
    """
    salt = F.pmod(salt_by, F.lit(2**bits)).cast("int")
    return big.withColumn("_salt", salt).join(repeated(small, "_salt", bits), [*keys, "_salt"], how).drop("_salt")


#: Rows of a few numbers each that are still broadcast (some tens of MB at most).
BROADCAST_ROWS = 500_000


def bounded(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, of which there are at most ``n``: broadcast if that is few, else joined by a shuffle."""
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows


def fresh(df: DataFrame, name: str) -> str:
    """``name``, longer by as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame, by: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose values are not in ``gone``.

    ``by`` maps columns of ``gone`` to expressions over ``docs``; NULLs are equal. ``gone`` is stored and
    counted, so that texts are not shuffled against a short list.
    """
    names = {c: fresh(docs, f"_gone_{c}") for c in by}
    listed = materialize(gone.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct(), "gone")
    same = F.lit(True)
    for c, expression in by.items():
        same = same & expression.eqNullSafe(F.col(names[c]))
    return docs.join(bounded(listed, listed.count()), same, "left_anti")


def repeated(df: DataFrame, name: str, bits: int) -> DataFrame:
    """``df`` once for every salt below ``2 ** bits``, in column ``name``."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(2**bits - 1))).alias(name))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send at most ``rows`` rows at once to Python, unless the session has a smaller number.

    A batch is held several times (JVM, Arrow, Python), so with whole texts the usual 10,000
    rows may need more memory than a worker has.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))
