"""Keep the fact in step with deliveries of the landed feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.plans.incremental import Build, ProgressStore, available_months, commit_months, pending_months
from tillworks.sources.landing import LANDED


def feed_stream(
    spark: SparkSession,
    feed_root: str,
    fact_root: str,
    build: Build,
    store: ProgressStore,
    checkpoint: str,
    kind: str = "invoice",
    max_files: int | None = None,
    trigger: dict | None = None,
):
    """Start a query that rebuilds every month touched by newly landed deliveries.

    The stream reads the ledger of the feed, one small file per delivery, which
    appears whole or not at all; the rows that changed in it name the months.  A
    micro-batch rebuilds those of them whose feed is newer than the version they
    were built from and commits rows and progress together.  So a month over
    several deliveries, a late one, a replayed batch and a batch that died half
    way all end in the same table as one batch run, and no state store is needed.
    The default trigger works off what is there and stops;
    ``trigger={"processingTime": "5 minutes"}`` keeps polling.
    """
    reader = spark.readStream.schema(LANDED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def rebuild(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        touched = batch.filter(F.col("since") == F.col("version")).select("year", "month").distinct()
        behind = pending_months(store.read((kind,)), available_months(session, feed_root), kind)
        # The list of months is bounded by the calendar.
        months = sorted((r.year, r.month) for r in touched.join(behind, ["year", "month"]).collect())
        if months:
            commit_months(session, feed_root, fact_root, build, store, kind, months)

    return (
        reader.parquet(f"{feed_root}/landed/v*")
        .writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
