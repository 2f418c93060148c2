"""What the text operators share: reading tables, id hashes, running totals."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tillworks.session import materialize, tune

# An Arrow batch ends at this many rows or bytes: texts vary from a few bytes to
# megabytes, and the memory of a Python worker is to stay bounded.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}
WHITE = r"[\x20\x09-\x0D]+"


def settings(spark: SparkSession) -> SparkSession:
    """The session settings these operators are written for."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return tune(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def beside(
    df: DataFrame, keep: list[str], inputs: list[Column], added: str, start: Callable[[], Callable[..., Sequence[Sequence]]]
) -> DataFrame:
    """The columns ``keep`` and the columns ``added`` (as DDL), row by row.

    ``start`` is called once a task; what it returns gets a list of values for each
    of ``inputs``, a batch at a time, and gives one list for each added column.
    Kept columns go around Python as they are: a long beside a null would lose
    digits on the way, and whatever their types or names are does not matter.
    """
    kept = df.select(*keep)
    fields = T.StructType.fromDDL(added).fields
    clash = {f.name for f in fields} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = [*keep, *[f.name for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            done = work(*[batch.column(i).to_pylist() for i in range(len(keep), batch.num_columns)])
            made = [pa.array(values, kind) for values, kind in zip(done, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], *made], names)

    # Input names that no kept column has.
    prefix = "_" * max([1, *(len(c) + 1 for c in keep)])
    source = df.select(*keep, *[c.alias(f"{prefix}{i}") for i, c in enumerate(inputs)])
    return source.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))


def running_total(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows before this one in ``order``.

    Rows are range-partitioned by ``order``, which must tell rows apart well
    enough to split any hot key, and summed within partitions; the sorted rows
    are written once, and the partitions' own totals, one row each, give the
    offsets.  Neither a single task nor the driver sees all rows.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_slice", T.IntegerType()), T.StructField("_at", T.LongType())])

    place = df.columns.index(value)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_id, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = pc.fill_null(batch.column(place), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(own)
            added = [pa.array(np.full(len(own), slice_id, np.int32)), pa.array(ends - own)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)
            total = int(ends[-1]) if len(own) else total

    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sums, schema), "running"
    )
    # One row per shuffle partition: bounded by the session's partition count.
    totals = sorted(placed.groupBy("_slice").agg(F.sum(value).alias("n")).collect())
    before, starts = 0, {}
    for row in totals:
        starts[row["_slice"]] = before
        before += row["n"]
    offsets = df.sparkSession.createDataFrame(
        [(k, v) for k, v in starts.items()], "_slice int, _offset long"
    )
    return (
        placed.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_at") + F.col("_offset"))
        .drop("_slice", "_at", "_offset")
    )
