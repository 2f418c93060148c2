"""Bridges that keep their scope, joined so that a rewrite never adds rows.

A bridge from old to current numbers is right within the scope it was found in
(an item of a vendor, a store at a site).  Without the scope one old number has
several current ones, and every join with it multiplies rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bridge_conflicts(bridge: DataFrame, keys: list[str], current: str) -> DataFrame:
    """The keys with several current values: how many, the lowest and the highest."""
    several = (
        bridge.select(*keys, current).distinct().groupBy(*keys)
        .agg(F.count(current).alias("n_current"), F.min(current).alias("lowest"), F.max(current).alias("highest"))
    )
    return several.filter("n_current > 1")


def single_valued(bridge: DataFrame, keys: list[str], current: str) -> DataFrame:
    """One row per key, with its lowest current value; ``bridge_conflicts`` reports what that decides."""
    return bridge.groupBy(*keys).agg(F.min(current).alias(current))


def rewrite_scoped(
    df: DataFrame, bridge: DataFrame, key: str, original: str, current: str, scope: dict[str, str]
) -> DataFrame:
    """Replace ``key`` by its current value within ``scope`` (columns of ``df`` to columns of ``bridge``).

    Guarded: the bridge is reduced to one row per key and scope before the join,
    so the result has exactly the rows of ``df``.  Text keys meet numeric ids as
    numbers; rows without a match, or with a null in key or scope, stay.
    """
    kind = df.schema[key].dataType
    numeric = bridge.schema[original].dataType.typeName() != "string" and kind.typeName() == "string"
    # Ids are widened before they are grouped, so that the join finds them where it needs them.
    ids = bridge.withColumn(original, F.col(original).cast("bigint")) if numeric else bridge
    ones = single_valued(ids, [original, *scope.values()], current)
    ones = ones.toDF("_from", *[f"_scope{i}" for i in range(len(scope))], "_to")
    probe = df[key].try_cast("bigint") if numeric else df[key]
    matches = [probe == ones["_from"], *[df[c] == ones[f"_scope{i}"] for i, c in enumerate(scope)]]
    joined = df.join(ones, reduce(lambda a, b: a & b, matches), "left")
    return joined.withColumn(key, F.coalesce(F.col("_to").cast(kind), key)).select(df.columns)
