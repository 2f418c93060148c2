"""Casts, dates, coordinates and measures.  Bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import rules

_CASTS = {"int": "int", "str": "string", "double": "double"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, fmt: str = rules.FEED_DATE_FORMAT) -> Column:
    return F.try_to_date(_col(c), fmt)


def cast_typed(c: Column | str, type: str, date_format: str = rules.FEED_DATE_FORMAT) -> Column:
    """Cast to ``int``, ``str``, ``double`` or ``date``; other names are refused."""
    if type == "date":
        return parse_date(c, date_format)
    if type not in _CASTS:
        raise ValueError(f"unsupported type {type!r}: use 'int', 'str', 'double' or 'date'")
    return _col(c).try_cast(_CASTS[type])


def feed_date(feed: DataFrame, column: str = "Date") -> Column:
    """The feed's date as a date, whether it was landed typed or is still text."""
    if feed.schema[column].dataType.typeName() == "string":
        return parse_date(column)
    return F.col(column).cast("date")


def split_point(c: Column | str, index: int, digits: int = 6) -> Column:
    """One coordinate of a ``POINT (lon lat)`` text: 1 is longitude, 2 latitude."""
    word = F.get(F.split(_col(c), " "), F.lit(index))
    return F.round(F.translate(word, "()", "").try_cast("double"), digits)


def sale_dollars(retail: Column | str, items: Column | str) -> Column:
    return F.round(_col(retail) * _col(items), 2)


def sale_baht(dollars: Column | str) -> Column:
    return F.round(_col(dollars) * rules.BAHT_PER_DOLLAR, 2)


def volume_liters(milliliters: Column | str, items: Column | str) -> Column:
    return (_col(milliliters).cast("bigint") * _col(items)) / 1000


def derive_measures(
    df: DataFrame,
    retail: str = "State Bottle Retail",
    items: str = "Items Sold",
    milliliters: str = "Bottle Volume ml",
) -> DataFrame:
    """Add sale dollars, sale baht and volume sold."""
    dollars = sale_dollars(retail, items)
    return df.withColumns(
        {
            "Sale Dollars": dollars,
            "Sale Baht": sale_baht(dollars),
            "Volume Sold Liters": volume_liters(milliliters, items),
        }
    )


def shift_calendar(c: Column | str, years: int = -rules.CALENDAR_OFFSET_YEARS) -> Column:
    """Move a date by whole years (Buddhist to Gregorian by default)."""
    return F.add_months(_col(c), years * 12)


def shift_calendar_text(c: Column | str, years: int = -rules.CALENDAR_OFFSET_YEARS) -> Column:
    """The same for ``yyyy-MM-dd`` text.

    The year is shifted before parsing, because a leap day such as 2563-02-29
    does not exist in the shifted calendar and would be lost as a date.
    """
    c = _col(c)
    year = F.substring(c, 1, 4).try_cast("int") + years
    return F.try_to_date(
        F.concat(F.lpad(year.cast("string"), 4, "0"), F.substring(c, 5, 6)), "yyyy-MM-dd"
    )


def round_money(c: Column | str) -> Column:
    return F.round(_col(c), 2)


def bool_to_string(c: Column | str) -> Column:
    return _col(c).cast("string")
