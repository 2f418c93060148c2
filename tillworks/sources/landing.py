"""A feed by month that grows by deliveries, and tables that grow by batches.

Data files go to ``files/run=<id>`` folders that are never changed; a ledger
beside them says which of them count.  A delivery is one ledger version: before
it readers see nothing of it, after it all of it, whatever happens in between.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.sources.ledger import Ledger, put
from tillworks.sources.months import MONTH, with_months

# ``since`` is the version in which a row changed, ``version`` the one it stands
# in; a month that a delivery no longer has keeps a row without a run.
LANDED = "delivery string, year int, month int, run string, since long, version long"
PUBLISHED = "batch string, run string"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_run(df: DataFrame, root: str, partition_by: list[str], sort_by: list[str] | None = None) -> str:
    """Write ``df`` as a new run under ``root`` and return the run's id; nobody reads it yet."""
    run = uuid.uuid4().hex
    spread = df.hint("rebalance", *partition_by) if partition_by else df
    if sort_by:
        spread = spread.sortWithinPartitions(*partition_by, *sort_by)
    spread.write.partitionBy(*partition_by).parquet(f"{root}/files/run={run}")
    return run


def months_of_run(spark: SparkSession, root: str, run: str) -> list[tuple[int | None, int | None]]:
    """The months of a run; its folders tell, no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/files/run={run}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    number = lambda p: (lambda v: None if v == NO_VALUE else int(v))(p.getName().split("=")[1])
    within = lambda p: [s.getPath() for s in files.listStatus(p) if "=" in s.getPath().getName()]
    return [(number(y), number(m)) for y in within(folder) for m in within(y)]


def read_months_of_runs(spark: SparkSession, root: str, found: list[tuple[str, int | None, int | None]]) -> DataFrame:
    """The rows of ``found``, a list of ``run, year, month``; only their folders are listed."""
    part = lambda v: NO_VALUE if v is None else v
    paths = [f"{root}/files/run={run}/Year={part(y)}/Month={part(m)}" for run, y, m in found]
    rows = spark.read.option("basePath", f"{root}/files").parquet(*paths).drop("run")
    return rows.withColumns({c: F.col(c).cast("int") for c in MONTH})


def landed(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/landed", LANDED)


def land(feed: DataFrame, root: str, delivery: str) -> int:
    """Add a delivery to the feed, beside what other deliveries hold of the same months.

    The same delivery again replaces what it landed before: a rerun changes
    nothing, and a corrected one leaves no old line.  Returns the ledger version.
    """
    spark = feed.sparkSession
    run = write_run(with_months(feed), root, MONTH)
    found = months_of_run(spark, root, run)

    def change(table: DataFrame, number: int) -> DataFrame:
        kind = table.schema
        mine = F.col("delivery").eqNullSafe(F.lit(delivery))
        new = spark.createDataFrame([(delivery, y, m, run, number, number) for y, m in found], kind)
        # Months this delivery had and has no more.
        gone = table.filter(mine & F.col("run").isNotNull()).withColumns({"run": F.lit(None).cast("string"), "since": F.lit(number).cast("long")})
        replaced = put(put(table, gone, ["delivery", "year", "month"]), new, ["delivery", "year", "month"])
        return replaced.withColumn("version", F.lit(number).cast("long"))

    return landed(spark, root).update(change)


def landed_months(spark: SparkSession, root: str) -> DataFrame:
    """``year, month, since``: the months that were ever landed and the version each last changed in."""
    return landed(spark, root).read().groupBy("year", "month").agg(F.max("since").alias("since"))


def read_landed(spark: SparkSession, root: str, months: list[tuple[int, int]] | None = None) -> DataFrame | None:
    """The landed feed with ``Year`` and ``Month``, whole or some months of it; None without any such rows.

    The list of folders is bounded by deliveries and months.
    """
    rows = landed(spark, root).read().filter(F.col("run").isNotNull()).select("run", "year", "month").collect()
    wanted = [tuple(r) for r in rows if months is None or (r.year, r.month) in set(months)]
    return read_months_of_runs(spark, root, wanted) if wanted else None


def publish_batch(df: DataFrame, root: str, batch: str, partition_by: list[str] | None = None) -> bool:
    """Append ``df`` to the table at ``root`` unless the batch of that name is there; whether it was appended.

    Files come first and count only once the ledger names their run, so a batch
    that dies between the two is invisible, and is published by its rerun.  Two
    writers of one batch leave one copy.
    """
    spark = df.sparkSession
    ledger = Ledger(spark, f"{root}/published", PUBLISHED)
    same = F.col("batch") == batch
    if not ledger.read().filter(same).isEmpty():
        return False
    run = write_run(df, root, partition_by or [])

    def change(table: DataFrame, _: int) -> DataFrame:
        first = table.filter(same)
        mine = spark.createDataFrame([(batch, run)], PUBLISHED)
        return table.filter(~same).unionByName(mine if first.isEmpty() else first)

    number = ledger.update(change)
    return not ledger.read(number).filter(same & (F.col("run") == run)).isEmpty()


def read_published(spark: SparkSession, root: str) -> DataFrame | None:
    """All published batches; None before the first."""
    runs = [r.run for r in Ledger(spark, f"{root}/published", PUBLISHED).read().select("run").collect()]
    paths = [f"{root}/files/run={run}" for run in runs]
    return spark.read.option("basePath", f"{root}/files").parquet(*paths).drop("run") if runs else None
