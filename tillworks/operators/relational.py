"""Filters, null and duplicate handling, bridge joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", extra: Column | None = None
) -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; keeps the left keys only.

    ``extra`` is one more condition, on left columns.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    matches = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    if extra is not None:
        matches.append(extra)
    joined = left.join(renamed, reduce(lambda a, b: a & b, matches), how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*[f"_r_{k}" for k in keys])


def filter_changed(df: DataFrame, before: str, after: str) -> DataFrame:
    """Rows whose two values differ; a null on either side drops the row."""
    return df.filter(F.col(before) != F.col(after))


def drop_null_any(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def drop_null_all(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_null_duplicates(df: DataFrame, column: str, partition_by: list[str]) -> DataFrame:
    """Drop rows null in ``column`` where another row of the group has a value.

    Groups without any value keep all their rows.  An anti join against the
    groups that have a value does this without holding a group in one task.
    """
    valued = df.filter(F.col(column).isNotNull()).select(*partition_by).distinct()
    return join_null_safe(df, valued, partition_by, "left_anti", df[column].isNull())


def apply_bridge(
    df: DataFrame, bridge: DataFrame, key: str, original: str, current: str, how: str = "left"
) -> DataFrame:
    """Replace ``key`` by its current value from the bridge.

    Text keys meet numeric bridge ids as numbers: a key that is not a number
    has no match and stays.  With ``how="inner"`` rows without a match go.
    """
    numeric_bridge = isinstance(bridge.schema[original].dataType, NumericType)
    text_key = isinstance(df.schema[key].dataType, StringType)
    key_type = df.schema[key].dataType
    pairs = bridge.select(
        F.col(original).alias("_from"), F.col(current).cast(key_type).alias("_to")
    )
    probe = df[key].try_cast("bigint") if numeric_bridge and text_key else df[key]
    joined = df.join(pairs, probe == pairs["_from"], how)
    return joined.withColumn(key, F.coalesce("_to", key)).drop("_from", "_to")


def unmatched_rows(df: DataFrame, bridge: DataFrame, key: str, original: str) -> DataFrame:
    """The rows an inner bridge join would drop: unknown or null keys."""
    known = bridge.select(F.col(original).alias("_from"))
    return df.join(known, df[key] == known["_from"], "left_anti")


def sort_output(df: DataFrame, *keys: str) -> DataFrame:
    """Global sort by ``keys``, then by all other columns.

    The further columns make the order definite and let the range partitioner
    split a key that holds much of the data.
    """
    return df.orderBy(*keys, *[c for c in df.columns if c not in keys])
