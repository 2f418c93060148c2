"""Most frequent values, and what is built from them.

A mode is two plain aggregations: count per (group, value), then the best count
per group.  Both combine map-side, so neither a large group nor one with very
many distinct values has to fit in one task, as it would in the hash map behind
the built-in ``mode``.  Ties go to the lowest value; nulls never win.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.operators.relational import filter_changed


def mode_of(
    df: DataFrame, keys: list[str], column: str, alias: str, weight: str | None = None
) -> DataFrame:
    """One row per group with its most frequent non-null ``column``.

    ``weight`` names a column saying how many source rows a row stands for.
    """
    return modes_of(df, keys, {alias: column}, weight)


def modes_of(
    df: DataFrame,
    keys: list[str],
    columns: dict[str, str],
    weight: str | None = None,
    lows: dict[str, str] | None = None,
    highs: dict[str, str] | None = None,
) -> DataFrame:
    """Independent modes of several columns (``{alias: column}``) in one scan.

    ``lows`` and ``highs`` add the minimum and maximum of further columns per
    group, so that no second pass or join is needed to bring them back.
    """
    lows, highs = lows or {}, highs or {}
    many = len(columns) > 1
    n = F.sum(weight) if weight else F.count(F.lit(1))

    # With several columns each row is repeated once per column, and every copy
    # counts one of them only.
    wide = df.withColumn("_slot", F.explode(F.array(*map(F.lit, range(len(columns)))))) if many else df
    counted_keys = [F.col(k) for k in keys] + (["_slot"] if many else [])
    values = [
        (F.when(F.col("_slot") == i, F.col(c)) if many else F.col(c)).alias(f"_v{i}")
        for i, c in enumerate(columns.values())
    ]
    extras = {a: (F.min, c) for a, c in lows.items()} | {a: (F.max, c) for a, c in highs.items()}
    counted = wide.groupBy(*counted_keys, *values).agg(
        n.alias("_n"), *[f(c).alias(f"_x_{a}") for a, (f, c) in extras.items()]
    )

    def best(i: int) -> Column:
        value = F.col(f"_v{i}")
        ranked = F.when(value.isNotNull(), F.struct((-F.col("_n")).alias("n"), value.alias("v")))
        return F.min(ranked)["v"]

    return counted.groupBy(*keys).agg(
        *[best(i).alias(a) for i, a in enumerate(columns)],
        *[f(f"_x_{a}").alias(a) for a, (f, _) in extras.items()],
    )


def canonical_by_mode(
    df: DataFrame, keys: list[str], column: str, weight: str | None = None
) -> DataFrame:
    """Replace ``column`` by its mode per ``keys``; rows with a null key get null."""
    modes = mode_of(df, keys, column, "_mode", weight)
    order = df.columns
    return df.drop(column).join(modes, keys, "left").withColumnRenamed("_mode", column).select(order)


def build_bridge(
    df: DataFrame,
    number: str,
    group_by: list[str],
    original: str,
    current: str,
    weight: str | None = None,
    scope: list[str] | None = None,
) -> DataFrame:
    """Old number to current number: the mode of ``number`` per group.

    Only changed numbers are kept; rows with a null in ``group_by`` have no group.
    ``scope`` names columns of the group within which a pair holds, kept between the two.
    """
    modes = mode_of(df, group_by, number, current, weight)
    pairs = df.join(modes, group_by, "left").select(F.col(number).alias(original), *(scope or []), current)
    return filter_changed(pairs, original, current).distinct()
