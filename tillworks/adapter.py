"""The wide sales feed from the seven star tables: every line, every column of the feed.

The expressions are plain SQL, so that a checking engine can build the same
rows.  Stores in runs of four share a name and a standard address, addresses of
some stores change with the year and come back, and spellings, counties and
vendor numbers are partly missing or wrong, so that every job has work to do.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.plans.tuples import LINES
from tillworks.session import tune

_GROUP = "CAST(c_custkey - c_custkey % 4 AS STRING)"
EXPRESSIONS = {
    "Invoice/Item Number": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)",
    "Date": "CAST(o_orderdate AS DATE)",
    "Store Number": "CAST(c_custkey AS INT)",
    "Store Name": f"'Shop & Co. ' || {_GROUP}",
    "Address": "CASE WHEN c_custkey % 50 = 0 THEN NULL"
    f" WHEN c_custkey % 3 = 0 AND year(o_orderdate) % 3 = 1 THEN {_GROUP} || ' E Lake Dr & Co'"
    f" WHEN c_custkey % 2 = 0 THEN {_GROUP} || ' N Main St.' ELSE {_GROUP} || ' North  \"Main\"' END",
    "City": "CASE WHEN c_custkey % 11 = 0 THEN 'Mt. Pleasant' ELSE n_name END",
    "Zip Code": "CASE WHEN c_custkey % 97 = 0 THEN '712-2' ELSE CAST(50000 + c_custkey % 1000 AS STRING) END",
    "Store Location": "'POINT (-9' || CAST(c_custkey % 10 AS STRING) || '.' || CAST(100000 + c_custkey AS STRING)"
    " || ' 4' || CAST(c_custkey % 7 AS STRING) || '.' || CAST(200000 + c_custkey AS STRING) || ')'",
    "County Number": "CASE WHEN n_nationkey = 7 OR o_orderkey % 5 = 0 THEN NULL ELSE CAST(n_nationkey AS INT) END",
    "County": "CASE WHEN n_nationkey % 6 = 0 THEN 'Cerro Gord' ELSE r_name END",
    "Category": "CAST(p_size AS INT)",
    "Category Name": "p_type",
    "Vendor Number": "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE CAST(l_suppkey AS INT) END",
    "Vendor Name": "CASE WHEN l_suppkey = 5 THEN 'Reservoir Distillery' ELSE s_name END",
    "Item Number": "CASE WHEN l_partkey % 2 = 0 THEN 'x' ELSE '' END || CAST(l_partkey AS STRING)",
    "Item Description": "p_name",
    "Pack": "CAST(p_size AS INT)",
    "Bottle Volume (ml)": "CAST(p_size * 10 AS INT)",
    "State Bottle Cost": "p_retailprice",
    "State Bottle Retail": "floor(l_extendedprice / l_quantity * 100) / 100",
    "Bottles Sold": "CAST(l_quantity AS INT)",
    "Sale (Dollars)": "l_extendedprice",
    "Volume Sold (Liters)": "CAST(p_size * l_quantity / 100 AS DOUBLE)",
    "Volume Sold (Gallons)": "CAST(p_size * l_quantity / 400 AS DOUBLE)",
}
_JOINS = (
    ("orders", "l_orderkey = o_orderkey"),
    ("customer", "o_custkey = c_custkey"),
    ("nation", "c_nationkey = n_nationkey"),
    ("region", "n_regionkey = r_regionkey"),
    ("part", "l_partkey = p_partkey"),
    ("supplier", "l_suppkey = s_suppkey"),
)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a DataFrame; how each join runs is left to adaptive execution.

    Orders meet their customer before the lines, and names of nations and
    regions come last, so that lines are moved once per large table and short.
    """
    tune(spark)
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    on = {name: F.expr(condition) for name, condition in _JOINS}
    placed = read("orders").join(read("customer"), on["customer"])
    wide = read("lineitem").join(placed, on["orders"])
    for name in ("supplier", "part", "nation", "region"):
        wide = wide.join(read(name), on[name])
    return wide.selectExpr(*[f"{e} AS `{c}`" for c, e in EXPRESSIONS.items()])


def places(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """``columns`` of the feed that hang on the order alone: a row per order, for as many lines as ``Feed Lines`` says.

    Lines are counted by order before they meet it, so only their order keys
    are moved, and what follows works on orders.
    """
    tune(spark)
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    on = {name: F.expr(condition) for name, condition in _JOINS}
    counted = read("lineitem").join(read("supplier"), on["supplier"]).join(read("part"), on["part"])
    counted = counted.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias(LINES))
    placed = read("orders").join(read("customer"), on["customer"]).join(counted, on["orders"])
    for name in ("nation", "region"):
        placed = placed.join(read(name), on[name])
    return placed.selectExpr(*[f"{EXPRESSIONS[c]} AS `{c}`" for c in columns], f"`{LINES}`")


def sales_sql() -> str:
    """The same rows as one SELECT."""
    columns = ", ".join(f'{e} AS "{c}"' for c, e in EXPRESSIONS.items())
    joins = " ".join(f"JOIN {name} ON {condition}" for name, condition in _JOINS)
    return f"SELECT {columns} FROM lineitem {joins}"
