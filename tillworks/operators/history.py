"""Validity ranges, current flags and sequence numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.operators.numbering import sequence_rows


def date_range(
    df: DataFrame,
    keys: list[str],
    low: str = "Date",
    high: str = "Date",
    from_name: str = "From Date",
    to_name: str = "To Date",
) -> DataFrame:
    """First and last date per group."""
    return df.groupBy(*keys).agg(F.min(low).alias(from_name), F.max(high).alias(to_name))


def build_history(ranges: DataFrame, key: list[str], sequence: str, among: Column | None = None) -> DataFrame:
    """Add ``Is Current`` and ``sequence`` to rows that carry a date range.

    Rows of a key are ordered by ``To Date``.  A value that comes back later
    keeps one row, from its first to its last day, so ranges may overlap.
    """
    return sequence_rows(ranges, key, ["To Date"], sequence=sequence, is_latest="Is Current", among=among)
