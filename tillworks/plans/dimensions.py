"""Small dimensions: category, vendor, county."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks import rules
from tillworks.functions import text, values
from tillworks.operators.modes import mode_of
from tillworks.operators.numbering import fill_null_ids, generate_id
from tillworks.operators.relational import drop_null_any, sort_output
from tillworks.plans.tuples import line_count


def build_category(feed: DataFrame) -> DataFrame:
    """One row per corrected category name, numbered in name order."""
    spelled = feed.select(text.clean_category("Category Name").alias("Category Name"))
    # Distinct before the dictionary, so that it runs once per spelling.
    names = drop_null_any(spelled, ["Category Name"]).distinct()
    corrected = names.select(
        values.correct_values("Category Name", rules.CATEGORY_NAME).alias("Category Name")
    ).distinct()
    numbered = generate_id(corrected, ["Category Name"], "Category Number")
    return numbered.select(
        values.add_prefix("Category Number", rules.CATEGORY_PREFIX).alias("Category Number"),
        "Category Name",
    )


def build_vendor(feed: DataFrame) -> DataFrame:
    """One row per vendor number with its usual corrected name.

    Names that never come with a number get new numbers after the highest.
    """
    raw = feed.groupBy(
        F.col("Vendor Number"), F.col("Vendor Name")
    ).agg(line_count(feed).alias("lines"))
    cleaned = raw.select(
        values.fix_vendor("Vendor Number", "Vendor Name").try_cast("int").alias("Vendor Number"),
        values.correct_values(
            text.clean_text("Vendor Name", "upper"), rules.VENDOR_NAME
        ).alias("Vendor Name"),
        "lines",
    )
    numbered = cleaned.filter(F.col("Vendor Number").isNotNull())
    usual = mode_of(numbered, ["Vendor Number"], "Vendor Name", "Vendor Name", "lines")
    loose = (
        cleaned.filter(F.col("Vendor Number").isNull() & F.col("Vendor Name").isNotNull())
        .select("Vendor Number", "Vendor Name")
        .distinct()
        .join(numbered.select("Vendor Name").distinct(), "Vendor Name", "left_anti")
    )
    vendors = fill_null_ids(usual.unionByName(loose), "Vendor Number")
    return sort_output(vendors, "Vendor Number").select(
        values.add_prefix("Vendor Number", rules.VENDOR_PREFIX).alias("Vendor Number"), "Vendor Name"
    )


def build_store_county(feed: DataFrame) -> DataFrame:
    """One row per (county number, corrected name)."""
    named = drop_null_any(feed.select("County Number", "County"), ["County Number"]).distinct()
    counties = named.select(
        values.add_prefix("County Number", rules.COUNTY_PREFIX).alias("County Number"),
        values.correct_values(text.upper_text("County"), rules.COUNTY_NAME).alias("County Name"),
    ).distinct()
    return counties
