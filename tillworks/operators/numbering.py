"""Row numbers without a window over one huge partition.

``Window.orderBy`` with no partition moves everything to one task, and a
partitioned window does the same to a key that holds much of the data.  Numbers
over a whole table, and those of heavy keys, come from range partitions: rows
are range-partitioned by the full sort key and sorted locally; a row's number is
its place in its partition plus the size of the partitions before it.  All other
keys are counted first and take a plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.operators.relational import join_null_safe
from tillworks.session import materialize

# A key with more rows than one task should sort is numbered over several.  Both
# ways give the same numbers.
HEAVY_ROWS = 1_000_000


def number_rows(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Number all rows from 1 in the order given (nulls first), ties by the other columns.

    The sorted rows are written once so that places are fixed before they are
    counted.  Rows equal in every column are told apart by the partition they
    came from, which spreads large groups of copies over several ranges.
    """
    keys = order_by + [c for c in df.columns if c not in order_by] + ["_src"]
    sort = [F.col(k).asc_nulls_first() for k in keys]
    placed = (
        df.withColumn("_src", F.spark_partition_id())
        .repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .drop("_src")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    # The id holds the partition in its upper bits and the place in the lower 33.
    placed = materialize(placed, "numbered").withColumns(
        {
            "_slice": F.shiftright("_at", 33),
            "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per shuffle partition, so both the window and the broadcast are
    # bounded by spark.sql.shuffle.partitions whatever the data.
    return (
        placed.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_at", "_slice", "_place", "_offset")
    )


def sequence_rows(
    df: DataFrame,
    partition_by: list[str],
    order_by: list[str],
    sequence: str | None = None,
    is_latest: str | None = None,
    among: Column | None = None,
) -> DataFrame:
    """Number rows per group from 1 (``sequence``) and flag the last (``is_latest``).

    Order is by ``order_by`` (nulls first), ties by the other columns.  Counts per
    key combine before the shuffle; only keys of more than ``HEAVY_ROWS`` rows are
    taken out of the window and sorted over several tasks.  ``among`` says which
    rows such keys can be found in, where the caller knows.
    """
    counted = df if among is None else df.filter(among)
    heavy = counted.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > HEAVY_ROWS).drop("_rows")
    if heavy.isEmpty():
        return _by_window(df, partition_by, order_by, sequence, is_latest)
    ordinary = join_null_safe(df, heavy, partition_by, "left_anti")
    rest = join_null_safe(df, heavy, partition_by, "left_semi")
    return _by_window(ordinary, partition_by, order_by, sequence, is_latest).unionByName(
        _by_ranges(rest, partition_by, order_by, sequence, is_latest)
    )


def _by_window(df: DataFrame, partition_by: list[str], order_by: list[str], sequence: str | None, is_latest: str | None) -> DataFrame:
    others = [c for c in df.columns if c not in order_by and c not in partition_by]
    rows = Window.partitionBy(*partition_by).orderBy(*[F.col(c).asc_nulls_first() for c in [*order_by, *others]])
    added = {}
    if sequence:
        added[sequence] = F.row_number().over(rows)
    if is_latest:
        # The same sort serves both.
        added[is_latest] = F.lead(F.lit(1)).over(rows).isNull()
    return df.withColumns(added)


def _by_ranges(df: DataFrame, partition_by: list[str], order_by: list[str], sequence: str | None, is_latest: str | None) -> DataFrame:
    """A group's numbers are the overall numbers less the group's first one, so a group may span any number of partitions."""
    numbered = number_rows(df, partition_by + order_by, "_n")
    spans = numbered.groupBy(*partition_by).agg(F.min("_n").alias("_first"), F.max("_n").alias("_last"))
    joined = join_null_safe(numbered, spans, partition_by)
    if sequence:
        joined = joined.withColumn(sequence, (F.col("_n") - F.col("_first") + 1).cast("int"))
    if is_latest:
        joined = joined.withColumn(is_latest, F.col("_n") == F.col("_last"))
    return joined.drop("_n", "_first", "_last")


def occurrence(df: DataFrame, partition_by: list[str], order_by: str, name: str) -> DataFrame:
    """A 1-based sequence per group."""
    return sequence_rows(df, partition_by, [order_by], sequence=name)


def most_recent_flag(df: DataFrame, partition_by: list[str], order_by: str, name: str) -> DataFrame:
    """True in exactly one row per group: the last of its sequence."""
    return sequence_rows(df, partition_by, [order_by], is_latest=name)


def generate_id(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Ids 1..n over the whole table in the order of ``order_by``."""
    return number_rows(df, order_by, name)


def fill_null_ids(df: DataFrame, column: str) -> DataFrame:
    """Give rows with a null id the ids following the highest one.

    Only those rows are numbered, ordered by their other columns.  A table with
    no id at all has nothing to follow and keeps its nulls.
    """
    highest = df.agg(F.max(column)).scalar()
    missing = df.filter(F.col(column).isNull())
    others = [c for c in df.columns if c != column]
    kind = df.schema[column].dataType
    filled = number_rows(missing, others or [column], "_n").withColumn(
        column, (highest + F.col("_n")).cast(kind)
    )
    return df.filter(F.col(column).isNotNull()).unionByName(filled.select(df.columns))


def keep_latest(df: DataFrame, partition_by: list[str], order_by: str) -> DataFrame:
    """The latest row per group (null dates last), ties to the highest other columns.

    A maximum over the row combines map-side, unlike a window.
    """
    ranked = [order_by] + [c for c in df.columns if c != order_by and c not in partition_by]
    top = df.groupBy(*partition_by).agg(F.max(F.struct(*ranked)).alias("_top"))
    return top.select(*[F.col(c) if c in partition_by else F.col("_top")[c].alias(c) for c in df.columns])
