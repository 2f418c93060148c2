"""Export to the later calendar and back."""

import datetime as dt
from pathlib import Path

import pytest

from tillworks import queries
from tillworks.plans import reconcile
from tillworks.schemas import schema_of


@pytest.mark.parametrize("table", ["invoice", "item_price_history", "store_address_history"])
def test_dates_come_back_leap_days_too(spark, tmp_path, table):
    schema = schema_of(table)
    days = [dt.date(2012, 2, 29), dt.date(2016, 2, 29), dt.date(2013, 2, 28), dt.date(1996, 12, 31), None]
    kinds = {"string": "x", "int": 7, "double": 1.239, "boolean": True}
    rows = [tuple(d if f.dataType.typeName() == "date" else kinds[f.dataType.simpleString()] for f in schema) for d in days]
    reconcile.export_table(table, spark.createDataFrame(rows, schema), f"{tmp_path}/csv")
    dated = [f.name for f in schema if f.dataType.typeName() == "date"]
    text = spark.read.option("header", True).csv(f"{tmp_path}/csv")
    assert {"2555-02-29", "2559-02-29", None} < {r[0] for r in text.select(dated[0]).collect()}
    reconcile.reconcile_file(spark, table, f"{tmp_path}/csv", f"{tmp_path}/out")
    done = spark.read.parquet(f"{tmp_path}/out")
    for c in dated:
        assert sorted(str(r[0]) for r in done.select(c).collect()) == sorted(map(str, days))
    if "Is Current" in done.columns:
        assert {r[0] for r in done.select("Is Current").collect()} == {"true"}
    if table == "item_price_history":
        assert {r[0] for r in done.select("State Bottle Cost").collect()} == {1.24}


def test_the_given_tables_hold_a_leap_day(spark):
    assert spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter("month(o_orderdate) = 2 AND day(o_orderdate) = 29").count() > 0


def test_only_the_reconciled_table_is_left(spark):
    """What the export was made from, and the export, are gone when the table has been read back."""
    files = lambda: {str(p) for p in Path(spark.conf.get("spark.checkpoint.dir")).rglob("part-*")}
    before = files()
    rows = queries.QUERIES["reconcile_item"](spark, "/root/testdata/sf0.001")
    left = files() - before
    assert rows.count() > 0 and left and all("/export-" in f and "/parquet/" in f for f in left)
