"""Reconciliation of exported tables: typed CSV in, corrected Parquet out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tillworks import rules
from tillworks.functions.typed import bool_to_string, round_money, shift_calendar_text
from tillworks.schemas import schema_of

# What each table needs besides being typed; dates arrive 543 years ahead.
_SHIFTED = {
    "invoice": ["Date"],
    "item_price_history": ["From Date", "To Date"],
    "store_address_history": ["From Date", "To Date"],
}
_ROUNDED = {
    "item": ["State Bottle cost", "State Bottle Retail"],
    "item_price_history": ["State Bottle Cost", "State Bottle Retail"],
}
_TEXT_FLAGS = {"item_price_history": ["Is Current"], "store_address_history": ["Is Current"]}


def export_schema(table: str) -> StructType:
    """The table's schema with shifted dates read as text, so leap days survive."""
    return StructType(
        [
            StructField(f.name, StringType() if isinstance(f.dataType, DateType) else f.dataType)
            for f in schema_of(table)
        ]
    )


def export_table(table: str, df: DataFrame, csv_path: str) -> None:
    """Write a table as the export that ``reconcile_file`` takes in, compressed.

    Dates of the shifted tables become text of the later calendar.  The year is
    moved as text: a leap day has no date there, and stays the 29th of February.
    """
    shifted = {c: _later_calendar(c) for c in _SHIFTED.get(table, [])}
    (df.withColumns(shifted) if shifted else df).write.option("header", True).option("compression", "gzip").csv(csv_path)


def _later_calendar(c: str) -> Column:
    day = F.date_format(c, "yyyy-MM-dd")
    year = F.substring(day, 1, 4).cast("int") + rules.CALENDAR_OFFSET_YEARS
    return F.concat(year.cast("string"), F.substring(day, 5, 6))


def reconcile(table: str, exported: DataFrame) -> DataFrame:
    """Undo the calendar shift, round money, turn flags into text."""
    changed: dict[str, Column] = {}
    for c in _SHIFTED.get(table, []):
        changed[c] = shift_calendar_text(F.col(c).cast("string"))
    for c in _ROUNDED.get(table, []):
        changed[c] = round_money(c)
    for c in _TEXT_FLAGS.get(table, []):
        changed[c] = bool_to_string(c)
    return exported.withColumns(changed) if changed else exported


def reconcile_file(spark: SparkSession, table: str, csv_path: str, out_path: str) -> None:
    """Read one exported CSV table, reconcile it and overwrite its Parquet copy."""
    exported = spark.read.schema(export_schema(table)).option("header", True).csv(csv_path)
    reconcile(table, exported).write.mode("overwrite").parquet(out_path)
