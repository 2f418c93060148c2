"""The month layout: ``Year=/Month=`` folders for the landed feed and the fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillworks.functions.typed import feed_date
from tillworks.schemas import schema_of

MONTH = ["Year", "Month"]


def with_months(feed: DataFrame) -> DataFrame:
    """Type the date and add its year and month."""
    dated = feed.withColumn("Date", feed_date(feed))
    return dated.withColumns({"Year": F.year("Date"), "Month": F.month("Date")})


def partition_by_month(feed: DataFrame, root: str) -> None:
    """Land the feed as Parquet by month, once, for all jobs to read.

    The rebalance hint gives each month as many files as its size needs: small
    months share a task, a month that holds much of the data is split.  Rows
    whose date does not parse land in the null partition.
    """
    write_months(with_months(feed), root, sort_by=[])


def read_month(
    spark: SparkSession, root: str, year: int, month: int, format: str = "parquet"
) -> DataFrame:
    """One month of the feed; partition pruning reads that folder only."""
    return read_months(spark, root, [(year, month)], format).drop(*MONTH)


def read_months(
    spark: SparkSession, root: str, months: list[tuple[int, int]], format: str = "parquet"
) -> DataFrame:
    """Some months of the feed, with ``Year`` and ``Month`` columns."""
    reader = spark.read.format(format)
    if format == "csv":
        declared = schema_of("sales_feed").add("Year", "int").add("Month", "int")
        reader = reader.option("header", True).schema(declared)
    years = {y: sorted(m for yy, m in months if yy == y) for y in sorted({y for y, _ in months})}
    wanted = [(F.col("Year") == y) & F.col("Month").isin(*ms) for y, ms in years.items()]
    return reader.load(root).filter(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def write_months(
    df: DataFrame,
    root: str,
    sort_by: list[str] | None = None,
    files_per_month: int | None = None,
    months: list[tuple[int, int]] | None = None,
) -> None:
    """Replace the months present in ``df`` and leave all others as they are.

    With ``months``, those of them that ``df`` does not hold lose their old rows
    too, once the rest is written; rows are counted by month during the write.

    Rerunning a month gives the same result.  Files are sorted inside, by
    ``Invoice_Item Number`` unless told otherwise; ``files_per_month`` fixes the
    number of files where a consumer wants, say, one per month.
    """
    sort_by = ["Invoice_Item Number"] if sort_by is None else sort_by
    seen = Observation()
    if months:
        counts = [F.count(F.when((F.col("Year") == y) & (F.col("Month") == m), 1)).alias(f"{y}-{m}") for y, m in months]
        df = df.observe(seen, *counts)
    if files_per_month:
        slot = F.pmod(F.xxhash64(*[c for c in df.columns if c not in MONTH]), F.lit(files_per_month))
        spread = df.repartition(*MONTH, slot)
    else:
        spread = df.hint("rebalance", *MONTH)
    (
        spread.sortWithinPartitions(*MONTH, *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*MONTH)
        .parquet(root)
    )
    if months:
        found = seen.get
        for y, m in months:
            if not found[f"{y}-{m}"]:
                _remove_folder(df.sparkSession, f"{root}/Year={y}/Month={m}")


def _remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
