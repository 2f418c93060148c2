"""One pass over the feed for all dimension jobs.

Every job starts from the distinct attributes of an item or of a store.  One
aggregation over two grouping sets gives both: the feed is read once, a line
becomes two tagged tuples, and counts and dates combine before the one shuffle.
The tuples are written by family; jobs read them as they would read the feed.
A source that knows its stores without its lines gives the families one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions.typed import feed_date

# Store tuples keep the day: a place counts once per day it was seen on.
FAMILIES = {
    "items": [
        "Item Number", "Item Description", "Category Name", "Vendor Number", "Vendor Name",
        "Pack", "Bottle Volume (ml)", "State Bottle Cost", "State Bottle Retail",
    ],
    "stores": [
        "Store Number", "Store Name", "Address", "City", "Zip Code", "Store Location", "County Number", "County", "Date",
    ],
}
LINES, FIRST, LAST = "Feed Lines", "First Date", "Last Date"


def line_count(feed: DataFrame) -> Column:
    """The number of feed lines, as an aggregate over lines or tuples."""
    return F.sum(LINES) if LINES in feed.columns else F.count(F.lit(1))


def first_date(feed: DataFrame) -> Column:
    """The first date of a line or tuple."""
    return F.col(FIRST) if LINES in feed.columns else feed_date(feed)


def last_date(feed: DataFrame) -> Column:
    """The last date of a line or tuple."""
    return F.col(LAST) if LINES in feed.columns else feed_date(feed)


def write_tuples(feed: DataFrame, path: str, families: dict[str, list[str]] = FAMILIES, ranged: bool = True) -> dict[str, DataFrame]:
    """Scan the feed once, write the tuples of ``families`` under ``path`` and read them back by family.

    ``families`` may name fewer columns than there are: tuples of what the jobs
    at hand read are fewer and shorter, and a single family needs no grouping set.
    Rows of ``feed`` may stand for several lines, as ``Feed Lines`` says.  Without
    ``ranged`` a single family has no first and last date.
    """
    columns = list(dict.fromkeys(c for family in families.values() for c in family))
    weight = [LINES] if LINES in feed.columns else []
    combined = [line_count(feed).alias(LINES)]
    if ranged or len(families) > 1:
        feed = feed.withColumn("_day", feed_date(feed))
        weight.append("_day")
        combined += [F.min("_day").alias(FIRST), F.max("_day").alias(LAST)]
    dated = feed.select(*[feed_date(feed).alias(c) if c == "Date" else c for c in columns], *weight)
    if len(families) == 1:
        grouped = dated.groupBy(*columns).agg(*combined)
        grouped.write.mode("overwrite").parquet(path)
        return {name: feed.sparkSession.read.schema(grouped.schema).parquet(path) for name in families}
    grouped = dated.groupingSets([[F.col(c) for c in f] for f in families.values()], *map(F.col, columns)).agg(
        F.grouping_id().alias("_set"), *combined
    )
    # A column outside the set has its bit; the families differ in their first column.
    in_items = F.col("_set").bitwiseAND(F.lit(1 << (len(columns) - 1))) == 0
    tagged = grouped.withColumn("family", F.when(in_items, "items").otherwise("stores")).drop("_set")
    tagged.write.mode("overwrite").partitionBy("family").parquet(path)
    read = feed.sparkSession.read.schema(tagged.schema).parquet(path)
    return {
        name: read.filter(F.col("family") == name).select(*family, LINES, FIRST, LAST) for name, family in families.items()
    }
