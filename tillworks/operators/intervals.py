"""Joins with validity ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAYS = 31


def month_bins(ranges: DataFrame, keys: list[str], low: str, high: str, pick: str) -> DataFrame:
    """``keys, _bin, _by_day``: per key and month, the highest ``pick`` valid on each day of it.

    A range is exploded to the months it touches.  The 31 maxima combine before
    the shuffle, so neither a key with very many ranges nor one long range has to
    fit in a task.  Ranges that are empty or open (a null bound) hold no day.
    """
    month = lambda c: F.trunc(c, "month")
    touched = ranges.filter(F.col(low) <= F.col(high)).withColumn(
        "_bin", F.explode(F.sequence(month(low), month(high), F.expr("interval 1 month")))
    )
    on_day = lambda d: F.date_add("_bin", d).between(F.col(low), F.col(high))
    days = touched.groupBy(*keys, "_bin").agg(*[F.max(F.when(on_day(d), F.col(pick))).alias(f"_d{d}") for d in range(DAYS)])
    return days.select(*keys, "_bin", F.array(*[f"_d{d}" for d in range(DAYS)]).alias("_by_day"))


def asof_join(df: DataFrame, ranges: DataFrame, keys: list[str], at: str, low: str, high: str, pick: str) -> DataFrame:
    """``df`` with ``pick`` of the range of the same keys that holds the date ``at``.

    Where ranges overlap the highest ``pick`` wins; without a range, a date or a
    key it is null.  Exactly the rows of ``df`` come back.

    The join is on keys and month, where the right side has one row, so there is
    no range condition to test pair by pair, and a hot key is spread over its
    months; what a single month of it still holds is left to the skew join.
    """
    bins = month_bins(ranges, keys, low, high, pick).withColumnsRenamed({k: f"_r_{k}" for k in keys})
    binned = df.withColumn("_at_bin", F.trunc(at, "month"))
    match = binned["_at_bin"] == bins["_bin"]
    for k in keys:
        match = match & (binned[k] == bins[f"_r_{k}"])
    joined = binned.join(bins, match, "left")
    return joined.withColumn(pick, F.get("_by_day", F.dayofmonth(at) - 1)).select(*df.columns, pick)
