"""CSV and Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillworks.schemas import schema_of


def read_data(
    spark: SparkSession,
    path: str,
    format: str = "csv",
    header: bool = True,
    inferSchema: bool | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read files with a declared schema, or an inferred one where asked for."""
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", header)
        if inferSchema is not None:
            reader = reader.option("inferSchema", inferSchema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def load_tables(spark: SparkSession, paths: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """Load tables by name, each from its ``(path, format)``, with its declared schema.

    A missing path or an unknown name raises.
    """
    return {
        name: read_data(spark, path, format, schema=schema_of(name))
        for name, (path, format) in paths.items()
    }


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    num_partitions: int | None = None,
    sort_by: list[str] | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Write a table, by default replacing it; CSV is compressed.

    ``num_partitions`` sets the number of files.  It moves rows, so the order
    inside the files is set afterwards, by ``sort_by``.
    """
    if num_partitions:
        df = df.repartition(num_partitions)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.format(format).mode(mode)
    if format == "csv":
        writer = writer.option("header", True).option("compression", "gzip")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
