"""Publishing to catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish_append(df: DataFrame, table: str, path: str | None = None) -> None:
    """Create the table if it is missing, else append to it.

    A second run appends the same rows again; see ``publish_replace``.
    """
    writer = df.write.format("parquet").mode("append")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def publish_replace(
    df: DataFrame, table: str, partition_by: list[str], path: str | None = None
) -> None:
    """Create the table if it is missing, else replace the partitions ``df`` holds.

    Rerunning gives the same table.
    """
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in partition_by]
    ordered = df.select(*rest, *partition_by).hint("rebalance", *partition_by)
    if not spark.catalog.tableExists(table):
        writer = ordered.write.format("parquet").partitionBy(*partition_by)
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(table)
        return
    # insertInto takes the mode from the session only.
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        ordered.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
