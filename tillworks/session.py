"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs are written for.  Joins carry no broadcast hints on
# data-dependent tables: adaptive execution broadcasts a side only when its
# measured size is under the threshold, and splits skewed partitions otherwise,
# also where the split costs one more shuffle downstream.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller already has."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session with nothing set falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="tillworks-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/tillworks/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, and unlike an
    RDD checkpoint the result keeps column pruning and file-size statistics.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    done = df.sparkSession.read.schema(df.schema).parquet(path)
    done._written_to = path
    if (owned := _made.get()) is not None:
        owned.append(path)
    return done


def release(*tables: DataFrame) -> None:
    """Delete the folders of tables that ``materialize`` returned, once what reads them has been written."""
    for df in tables:
        _delete(df.sparkSession, df._written_to)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# The folders that ``materialize`` has made since the innermost ``scratch`` began.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession, *, delete: bool = True) -> Iterator[list[str]]:
    """Own the folders that ``materialize`` makes in the block: a list of them.

    They are deleted at its end, as whatever reads them must have been written
    by then; with ``delete=False`` the caller does that, by ``drop_folders``.
    """
    owned: list[str] = []
    outer = _made.set(owned)
    try:
        yield owned
    finally:
        _made.reset(outer)
        if delete:
            drop_folders(spark, owned)


def own(folders: list[str]) -> None:
    """Give ``folders`` to the ``scratch`` that is open here, if any: they outlive an inner one."""
    if (owned := _made.get()) is not None:
        owned.extend(folders)


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete ``folders`` and empty the list."""
    while folders:
        _delete(spark, folders.pop())
