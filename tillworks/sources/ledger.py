"""A small table kept as numbered versions, for several writers.

A writer reads the latest version, writes the changed table whole into a folder
of its own and renames that folder to the next number.  The rename succeeds for
one writer only; the others read again and try the next number, so no change is
lost.  A version is there whole or not at all, and a writer that dies leaves
nothing but a folder that no reader looks at.

The table is bounded by what it lists (months, deliveries, batches), so one file
a version is enough.  Versions stay, so a reader of an old one is not disturbed,
and a stream over the folder sees every change.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ATTEMPTS = 50


class Ledger:
    """Versions ``v<number>`` of a table with the columns of ``ddl`` under ``root``."""

    def __init__(self, spark: SparkSession, root: str, ddl: str):
        self.spark, self.root, self.ddl = spark, root.rstrip("/"), ddl

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def latest(self) -> int:
        """The number of the latest version; 0 before any."""
        files = self._files()
        if not files.exists(self._path()):
            return 0
        names = [s.getPath().getName() for s in files.listStatus(self._path())]
        return max((int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()), default=0)

    def read(self, number: int | None = None) -> DataFrame:
        number = self.latest() if number is None else number
        if not number:
            return self.spark.createDataFrame([], self.ddl)
        return self.spark.read.schema(self.ddl).parquet(f"{self.root}/{_name(number)}")

    def update(self, change: Callable[[DataFrame, int], DataFrame]) -> int:
        """Commit ``change(table, number)`` as the next version; tried again on the new table when another writer was first."""
        for _ in range(ATTEMPTS):
            before = self.latest()
            mine = f"_{uuid.uuid4().hex}"
            change(self.read(before), before + 1).coalesce(1).write.parquet(f"{self.root}/{mine}")
            if self._claim(mine, before + 1):
                return before + 1
        raise RuntimeError(f"{self.root} had {ATTEMPTS} other writers in a row")

    def _claim(self, mine: str, number: int) -> bool:
        """Whether the folder ``mine`` has become the version ``number``."""
        jvm, files = self.spark._jvm, self._files()
        files.create(self._path(f"{mine}/_{mine}")).close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path().toUri(), self.spark._jsc.hadoopConfiguration())
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(self._path(mine), self._path(_name(number)), never)
        except Py4JJavaError:
            # Another writer has the number, or the rename failed: the mark below tells.
            pass
        # A store whose rename puts a folder into an existing one is told by the mark's place.
        won = files.exists(self._path(f"{_name(number)}/_{mine}"))
        if not won:
            for left in (mine, f"{_name(number)}/{mine}"):
                files.delete(self._path(left), True)
        return won


def _name(number: int) -> str:
    return f"v{number:012d}"


def put(table: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """``table`` with ``updates`` in place of the rows of the same key, nulls equal to nulls."""
    same = F.lit(True)
    keys = updates.select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return table.join(F.broadcast(keys), same, "left_anti").unionByName(updates.select(table.columns))
