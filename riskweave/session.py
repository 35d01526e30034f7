"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "riskweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC timestamps and adaptive execution; ``conf`` adds settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package, wherever the application was started.

    Functions that run in Python workers are sent by name. The sources (some 100 kB) are
    zipped and added to the application once.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="riskweave-"), "riskweave.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a folder of this machine; on a cluster
    an unset folder is an error, because executors could not read it back.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="riskweave-")
    sc.setCheckpointDir(local)
    return local


_OPEN: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str, outlives: bool = False) -> str:
    """A fresh path below the scratch folder. If it ``outlives`` the innermost open scope, that does not delete it."""
    path = f"{scratch_dir(spark).rstrip('/')}/riskweave/{name}-{uuid.uuid4().hex}"
    for made in _OPEN[:-1] if outlives else _OPEN:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the stored copies made inside the block when it ends.

    Results are lazy and read the copies, so write them within the block:
    ``with scratch_scope(spark): heart.run(...)["olap"]["risk_by_gender"].write.parquet(out)``.
    """
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def materialize(df: DataFrame, name: str, spread: bool = False, codec: str | None = None, outlives: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the scratch folder and read it back.

    The copy outlives lost executors, later passes read only the columns they
    need, and non-deterministic columns are fixed by being stored. ``spread``
    gives each core a file where the table is so small (a few megabytes per
    core) that a scan would leave cores idle in compute-heavy passes. ``codec`` names
    another compression than the session's, for copies that hold texts. One that ``outlives`` the
    innermost :func:`scratch_scope` is deleted with the next outer one.
    """
    spark = df.sparkSession

    def stored(rows: DataFrame) -> DataFrame:
        path = scratch_path(spark, name, outlives)
        rows.write.parquet(path, compression=codec)
        return spark.read.schema(df.schema).parquet(path)

    copy = stored(df)
    cores = spark.sparkContext.defaultParallelism
    if spread and copy.rdd.getNumPartitions() < cores:
        copy = stored(copy.repartition(cores))
    return copy
