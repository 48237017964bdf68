"""Session factory and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Paths in the shared folder that this program wrote and hasn't removed yet.
_written: list[str] = []


def get_spark(app: str = "chronofold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, ANSI and adaptive execution; ``conf`` overrides any setting.

    Shuffle partitions are left to the cluster's own setting: adaptive execution coalesces small
    ones, so a value sized for the largest stage is right for the others too.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k: str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, a temporary folder on one machine, as in tests; RuntimeError on a cluster, whose executors share no such folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="chronofold-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, suffix: str = "") -> str:
    """A new path in the shared folder, which is removed when the session's program ends, or by release()."""
    path = f"{checkpoint_root(spark)}/chronofold/{uuid.uuid4().hex}{suffix}"
    if not _written:
        atexit.register(release, spark)
    _written.append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and survives lost executors.

    Used where a result is read more than once and costs Python work or iterations to make again.
    """
    path = scratch_path(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._chronofold_path = path
    return out


def drop_materialized(*dfs: DataFrame | None) -> None:
    """Remove the tables behind results of materialize() that nothing reads any more; other DataFrames are left alone."""
    for df in dfs:
        path = getattr(df, "_chronofold_path", None)
        if path in _written:
            _remove(df.sparkSession, path)
            _written.remove(path)


def release(spark: SparkSession) -> int:
    """Remove every table this program has written to the shared folder and kept; the number removed. Results that read them must have been written or collected before."""
    n = 0
    while _written:
        path = _written.pop()
        with contextlib.suppress(Exception):  # at the end of a program the session may be gone
            _remove(spark, path)
            n += 1
    return n


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is materialized inside is removed at the end of the block, also if it fails."""
    before = len(_written)
    try:
        yield
    finally:
        while len(_written) > before:
            _remove(spark, _written.pop())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test or warehouse table stored as ``<dir>/<name>.parquet`` (a file or a folder)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
