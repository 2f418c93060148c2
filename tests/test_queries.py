"""Every registered table query against its SQL, and what the jobs must hold to."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillworks import queries
from tillworks.plans import incremental
from tillworks.sources import months, publish

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(df: pd.DataFrame) -> list:
    def cell(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
            return "~"
        if isinstance(x, (int, float, np.integer, np.floating)) and not isinstance(x, (bool, np.bool_)):
            return repr(round(float(x), 6))
        return str(x)[:10] if hasattr(x, "year") else str(x)

    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours = queries.QUERIES[name](spark, DATA).toPandas()
    theirs = duck.sql(queries.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)


@pytest.mark.parametrize("name,keys", [("item_price_history", ["item_number", "vendor_number"]), ("store_address_history", ["store_number"])])
def test_history_has_one_current_row_and_gapless_sequences(spark, name, keys):
    df = queries.QUERIES[name](spark, DATA)
    sequence = [c for c in df.columns if c.endswith("sequence")][0]
    by_key = df.groupBy(*keys).agg(F.sum(F.col("is_current").cast("int")).alias("c"), F.max(sequence).alias("m"), F.count("*").alias("n"), F.countDistinct(sequence).alias("d"))
    assert by_key.filter("c <> 1 OR m <> n OR d <> n").count() == 0
    assert by_key.filter("n > 1").count() > 0


def test_bridges_hold_no_identity(spark):
    df = queries.QUERIES["store_number_bridge"](spark, DATA)
    assert df.count() > 0
    assert df.filter("original_store_number = current_store_number").count() == 0


def test_publish_replace_keeps_other_partitions_and_the_setting(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "x int, month int")
    publish.publish_replace(df, "replaced", ["month"], str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    publish.publish_replace(df.filter("x = 3"), "replaced", ["month"])
    assert sorted(map(tuple, spark.table("replaced").collect())) == [(1, 1), (3, 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_upsert_leaves_one_row_of_a_key(spark):
    old = spark.createDataFrame([("invoice", 2012, 1, "File Created"), ("invoice", 2012, 10, "File Created")], "kind string, year int, month int, status string")
    new = spark.createDataFrame([("invoice", 2012, 1, "File Created"), ("invoice", 2012, 1, incremental.NOT_UPLOADED)], old.schema)
    done = sorted(map(tuple, incremental.upsert_checkpoint(old, new).collect()))
    assert done == [("invoice", 2012, 1, incremental.NOT_UPLOADED), ("invoice", 2012, 10, "File Created")]


def test_a_month_rebuilt_to_nothing_loses_its_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2012, 1), (2, 2012, 2), (3, 2012, 3)], "x int, Year int, Month int")
    path = str(tmp_path / "fact")
    months.write_months(rows, path, sort_by=["x"])
    months.write_months(rows.filter("x = 2"), path, sort_by=["x"], months=[(2012, 2), (2012, 3)])
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 2]


def test_monthly_feed_takes_failed_months_first_and_goes_on_after_an_error(spark, tmp_path, monkeypatch):
    feed = spark.createDataFrame([(1, 2012, m) for m in range(1, 6)], "x int, Year int, Month int")
    feed.write.partitionBy("Year", "Month").parquet(str(tmp_path / "feed"))
    store, runs = incremental.ProgressStore(spark, str(tmp_path / "progress")), []
    store.mark("invoice", [(2012, 4)], incremental.NOT_UPLOADED)

    def run(spark, feed_root, fact_root, dims, wanted):
        runs.append(wanted)
        if (2012, 1) in wanted:
            raise ValueError("bad month")

    monkeypatch.setattr(incremental, "run_months", run)
    with pytest.raises(ValueError):
        incremental.monthly_feed(spark, str(tmp_path / "feed"), "", {}, store, batch=2)
    assert runs == [[(2012, 4)], [(2012, 1), (2012, 2)], [(2012, 3), (2012, 5)]]
    failed = {(r.year, r.month) for r in incremental.backfill_list(store.read(), "invoice").collect()}
    assert failed == {(2012, 1), (2012, 2)}
