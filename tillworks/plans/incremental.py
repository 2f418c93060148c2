"""Progress by month: checkpoints, backfill and the monthly feed.

Progress is a table of (kind, year, month, status).  There are three
independent kinds.  A month counts as done only under a done status.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks import rules
from tillworks.plans.fact import build_fact
from tillworks.plans.refresh import FACT_INPUTS
from tillworks.session import new_folder
from tillworks.sources.landing import landed, landed_months, months_of_run, read_landed, read_months_of_runs, write_run
from tillworks.sources.ledger import Ledger
from tillworks.sources.months import MONTH, read_months

# The progress kinds and the statuses.
KINDS = ("invoice", "gcs", "bigquery")
CREATED, UPLOADED, NOT_UPLOADED = "File Created", "UPLOADED", "NOT UPLOADED"
DONE = (CREATED, UPLOADED)
PROGRESS_KEY = ["kind", "year", "month"]
PROGRESS_DDL = "kind string, year int, month int, status string, run string, source long"


def _check(kind: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"unknown progress kind {kind!r}: use one of {KINDS}")
    return kind


def _first_day(year: str = "year", month: str = "month"):
    return F.make_date(year, month, F.lit(1))


def latest_checkpoint(progress: DataFrame, kind: str) -> DataFrame:
    """One row: the latest done month of ``kind``, or the default before any."""
    year, month = rules.FIRST_CHECKPOINT
    done = progress.filter((F.col("kind") == _check(kind)) & F.col("status").isin(*DONE))
    day = F.coalesce(F.max(_first_day()), F.make_date(F.lit(year), F.lit(month), F.lit(1)))
    return done.agg(day.alias("day")).select(
        F.year("day").alias("year"), F.month("day").alias("month")
    )


def next_month(progress: DataFrame, kind: str) -> DataFrame:
    """One row: the month after the latest done one."""
    following = F.add_months(_first_day(), 1)
    return latest_checkpoint(progress, kind).select(
        F.year(following).alias("year"), F.month(following).alias("month")
    )


def upsert_checkpoint(progress: DataFrame, updates: DataFrame) -> DataFrame:
    """Progress with ``updates`` in place of rows of the same kind, year and month.

    Several updates of one key leave one row, a failed one before any other.
    """
    rest = [c for c in progress.columns if c not in PROGRESS_KEY]
    rank = F.struct((F.col("status") == NOT_UPLOADED).alias("_failed"), *rest)
    single = updates.groupBy(*PROGRESS_KEY).agg(F.max(rank).alias("_top"))
    single = single.select(*PROGRESS_KEY, *[F.col("_top")[c].alias(c) for c in rest])
    kept = progress.join(single.select(*PROGRESS_KEY), PROGRESS_KEY, "left_anti")
    return kept.unionByName(single.select(progress.columns))


def backfill_list(progress: DataFrame, kind: str) -> DataFrame:
    """Months whose last try failed."""
    failed = (F.col("kind") == _check(kind)) & (F.col("status") == NOT_UPLOADED)
    return progress.filter(failed).select("year", "month")


def backfill_plan(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected months that are not present; both have ``year`` and ``month``."""
    return (
        expected.select("year", "month")
        .distinct()
        .join(present.select("year", "month"), ["year", "month"], "left_anti")
    )


def months_of(feed: DataFrame) -> DataFrame:
    """The months a landed feed holds."""
    return (
        feed.select(F.col("Year").alias("year"), F.col("Month").alias("month"))
        .filter(F.col("year").isNotNull())
        .distinct()
    )


class ProgressStore:
    """Progress and the runs that hold each month's rows, as one ledger per kind.

    A month's status and the run its rows are in change in one version, so data
    and progress agree whatever dies in between; writers of a kind take turns by
    optimistic versions and writers of different kinds never meet.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _ledger(self, kind: str) -> Ledger:
        return Ledger(self.spark, f"{self.root}/{_check(kind)}", PROGRESS_DDL)

    def read(self, kinds: tuple[str, ...] = KINDS) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._ledger(k).read() for k in kinds])

    def upsert(self, updates: DataFrame) -> None:
        """Record ``updates``, of any kinds; columns they lack keep their old values."""
        kinds = [r.kind for r in updates.select("kind").distinct().collect()]
        for kind in sorted(map(_check, kinds)):
            mine = updates.filter(F.col("kind") == kind)
            self._ledger(kind).update(lambda table, _, mine=mine: upsert_checkpoint(table, _filled(mine, table)))

    def mark(
        self, kind: str, months: list[tuple[int, int]], status: str, runs: dict[tuple[int, int], str] | None = None, source: int | None = None
    ) -> None:
        """Record a status; with ``runs`` also where the rows of the months now are (a month without one is empty)."""
        rows = [(_check(kind), y, m, status) for y, m in months]
        updates = self.spark.createDataFrame(rows, "kind string, year int, month int, status string")
        if runs is not None:
            places = [(kind, y, m, status, runs.get((y, m)), source) for y, m in months]
            updates = self.spark.createDataFrame(places, PROGRESS_DDL)
        self.upsert(updates)


def _filled(updates: DataFrame, table: DataFrame) -> DataFrame:
    """``updates`` with the columns they lack from the rows of ``table`` they replace."""
    missing = [c for c in table.columns if c not in updates.columns]
    if not missing:
        return updates.select(table.columns)
    old = table.select(*PROGRESS_KEY, *missing)
    return updates.join(old, PROGRESS_KEY, "left").select(table.columns)


Build = dict[str, DataFrame] | Callable[[DataFrame], DataFrame]


def run_months(
    spark: SparkSession, feed_root: str, fact_root: str, build: Build, months: list[tuple[int, int]]
) -> dict[tuple[int, int], str]:
    """Build whole months from the landed feed into a new run; the run of each month that has rows.

    ``build`` is a function of the feed, or the tables the invoice fact needs.
    Nobody reads the run before the months are marked with it.
    """
    feed = feed_months(spark, feed_root, months)
    if feed is None:
        return {}
    made = build(feed) if callable(build) else build_fact(feed, *[build[n] for n in FACT_INPUTS])
    sort_by = ["Invoice_Item Number"] if "Invoice_Item Number" in made.columns else None
    run = write_run(made, fact_root, MONTH, sort_by)
    return {m: run for m in months_of_run(spark, fact_root, run)}


def feed_months(spark: SparkSession, feed_root: str, months: list[tuple[int, int]]) -> DataFrame | None:
    """Some months of a feed landed by deliveries, or of a plain month layout."""
    if landed(spark, feed_root).latest():
        return read_landed(spark, feed_root, months)
    return read_months(spark, feed_root, months)


def available_months(spark: SparkSession, feed_root: str) -> DataFrame:
    """``year, month, since`` of a feed; a plain month layout does not tell when a month changed."""
    if landed(spark, feed_root).latest():
        return landed_months(spark, feed_root).filter(F.col("year").isNotNull())
    return months_of(spark.read.parquet(feed_root)).withColumn("since", F.lit(0).cast("long"))


def read_fact(spark: SparkSession, fact_root: str, store: ProgressStore, kind: str = "invoice") -> DataFrame | None:
    """The rows of all months that count, with ``Year`` and ``Month``; None before the first.

    A month whose rebuild failed keeps its earlier rows.
    """
    rows = store.read((kind,)).filter(F.col("run").isNotNull()).select("run", "year", "month").collect()
    return read_months_of_runs(spark, fact_root, [tuple(r) for r in rows]) if rows else None


def commit_months(
    spark: SparkSession,
    feed_root: str,
    fact_root: str,
    build: Build,
    store: ProgressStore,
    kind: str,
    months: list[tuple[int, int]],
) -> None:
    """Build months and make them count, all in one version of the progress.

    The feed's version is read first: what lands during the build makes its
    month pending again.  A build that fails marks the months for backfill.
    """
    source = landed(spark, feed_root).latest()
    try:
        runs = run_months(spark, feed_root, fact_root, build, months)
    except Exception:
        store.mark(kind, months, NOT_UPLOADED)
        raise
    store.mark(kind, months, CREATED, runs or {}, source)


def pending_months(progress: DataFrame, available: DataFrame, kind: str) -> DataFrame:
    """Available months that are not done, or changed after the version they were built from."""
    done = progress.filter((F.col("kind") == _check(kind)) & F.col("status").isin(*DONE))
    built = done.select("year", "month", F.coalesce("source", F.lit(0)).alias("_built"))
    return available.join(built, ["year", "month"], "left").filter("_built IS NULL OR since > _built").select("year", "month")


def monthly_feed(
    spark: SparkSession,
    feed_root: str,
    fact_root: str,
    build: Build,
    store: ProgressStore,
    kind: str = "invoice",
    until: tuple[int, int] | None = None,
    batch: int = 12,
) -> list[tuple[int, int]]:
    """Bring the fact up to date: failed months first, then the missing and the changed ones.

    Failed months run one by one, the rest in runs of ``batch`` months, which
    leaves the result alone.  Their list is bounded by the calendar; months
    without feed data stay pending.  A run that fails marks its months for
    backfill, the others go on, and the first error is raised at the end.  A
    process that dies anywhere is made good by the next call: what it had not
    committed was never seen.  Returns the months written; ``read_fact`` reads them.
    """
    available = available_months(spark, feed_root)
    if until:
        available = available.filter(
            F.struct("year", "month") <= F.struct(F.lit(until[0]), F.lit(until[1]))
        )
    progress = store.read((kind,))
    pending = [(r.year, r.month) for r in pending_months(progress, available, kind).sort("year", "month").collect()]
    failed = {(r.year, r.month) for r in backfill_list(progress, kind).collect()}
    rest = [m for m in pending if m not in failed]
    runs = [[m] for m in pending if m in failed] + [rest[i : i + batch] for i in range(0, len(rest), batch)]
    written, errors = [], []
    for run in runs:
        try:
            commit_months(spark, feed_root, fact_root, build, store, kind, run)
        except Exception as error:
            errors.append(error)
        else:
            written += run
    if errors:
        raise errors[0]
    return written


def new_store(spark: SparkSession) -> ProgressStore:
    """A store in a fresh folder, for trial runs."""
    return ProgressStore(spark, new_folder(spark, "progress"))
