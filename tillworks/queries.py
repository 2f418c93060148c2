"""The registered queries of the table engine, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks import rules
from tillworks import table_sql as sql
from tillworks.adapter import places, sales, sales_sql
from tillworks.functions import text, typed, values
from tillworks.operators import bridges, history, modes, numbering, relational
from tillworks.plans import fact, incremental, reconcile, stores
from tillworks.plans.refresh import ASOF_INPUTS, FACT_INPUTS, JOBS, families_of, ranged_families
from tillworks.plans.tuples import FAMILIES, write_tuples
from tillworks.session import drop_folders, materialize, new_folder, own, scratch, tune
from tillworks.sources import files, landing, months, publish
from tillworks.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle:
            ORACLES[name] = f"WITH sales AS ({sales_sql()}) {oracle}" if "sales" in oracle else oracle
        return query

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def _column_query(name: str, columns: dict[str, str], expression, oracle: str, source: str = "sales") -> None:
    """A query that shows its inputs beside one computed column, distinct."""
    listed = ", ".join(f'"{c}" AS {a}' for a, c in columns.items())

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = sales(spark, sf_dir) if source == "sales" else _read(spark, sf_dir, source)
        return df.select(*[F.col(c).alias(a) for a, c in columns.items()], expression().alias("result")).distinct()

    register(name, f"SELECT DISTINCT {listed}, {oracle} AS result FROM {source}")(query)


# Scalar functions.

_SMALL = {"ALGERIA": "Algiers", "FRANCE": "Paris", "NATION_1": "First", "NATION_2": "Second"}
_column_query("initcap_words", {"name": "p_name"}, lambda: text.initcap_words("p_name"), sql.INITCAP.format("p_name"), "part")
_column_query("upper_text", {"url": "url"}, lambda: text.upper_text("url"), "upper(url)", "pages")
_column_query("clean_text", {"address": "Address"}, lambda: text.clean_text("Address", "upper"), f"upper({sql.CLEAN.format(chr(34) + 'Address' + chr(34))})")
_column_query("trim_spaces", {"city": "City"}, lambda: text.trim_spaces(F.concat(F.lit("  "), "City", F.lit(" "))), 'trim(\'  \' || "City" || \' \')')
_column_query("squeeze_spaces", {"address": "Address"}, lambda: text.squeeze_spaces("Address"), "replace(\"Address\", '  ', ' ')")
_column_query("remove_patterns", {"url": "url"}, lambda: text.remove_patterns("url", ["[0-9]+", r"\?.*"]), r"regexp_replace(regexp_replace(url, '[0-9]+', '', 'g'), '\?.*', '', 'g')", "pages")
_column_query("replace_pattern", {"url": "url"}, lambda: text.replace_pattern("url", "^https?", "web"), "regexp_replace(url, '^https?', 'web', 'g')", "pages")
_column_query("clean_description", {"name": "p_name"}, lambda: text.clean_description("p_name"), sql.INITCAP.format("translate(p_name, '.\"''�°', '')"), "part")
_column_query("clean_item_number", {"item": "Item Number"}, lambda: text.clean_item_number("Item Number"), "translate(\"Item Number\", 'x', '')")
_column_query("standardize_address", {"address": "Address"}, lambda: text.standardize_address("Address"), sql.address_sql('"Address"'))
_column_query("correct_values", {"city": "City"}, lambda: values.correct_values("City", _SMALL), sql.case_sql('"City"', _SMALL))
_column_query("override_by_key", {"store": "Store Number", "city": "City"}, lambda: values.override_by_key("City", "Store Number", rules.STORE_CITY | {3: "Three", 4: "Four"}), sql.case_sql('"City"', rules.STORE_CITY | {3: "Three", 4: "Four"}, '"Store Number"'))
_column_query("replace_when", {"county": "County Number", "city": "City"}, lambda: values.replace_when("City", F.col("County Number") > 10, F.lit("far")), "CASE WHEN \"County Number\" > 10 THEN 'far' ELSE \"City\" END")
_column_query("prefer", {"address": "Address", "city": "City"}, lambda: values.prefer("Address", "City"), 'coalesce("Address", "City")')
_column_query("fix_vendor", {"number": "Vendor Number", "vendor": "Vendor Name"}, lambda: values.fix_vendor("Vendor Number", "Vendor Name"), "CASE WHEN upper(\"Vendor Name\") = 'RESERVOIR DISTILLERY' THEN '988' ELSE CAST(\"Vendor Number\" AS VARCHAR) END")
_column_query("add_prefix", {"vendor": "Vendor Number"}, lambda: values.add_prefix("Vendor Number", "VEN_"), "'VEN_' || \"Vendor Number\"")
_column_query("cast_typed", {"zip": "Zip Code"}, lambda: typed.cast_typed("Zip Code", "int"), 'TRY_CAST("Zip Code" AS INT)')
_column_query("parse_date", {"day": "Date"}, lambda: typed.parse_date(F.date_format("Date", "MM/dd/yyyy")), '"Date"')
_column_query("split_point", {"location": "Store Location"}, lambda: typed.split_point("Store Location", 1), "round(TRY_CAST(translate(string_split(\"Store Location\", ' ')[2], '()', '') AS DOUBLE), 6)")
_column_query("shift_calendar", {"day": "Date"}, lambda: typed.shift_calendar("Date", 10), 'CAST("Date" + INTERVAL 10 YEAR AS DATE)')
_column_query("round_money", {"price": "p_retailprice"}, lambda: typed.round_money(F.col("p_retailprice") / 4), "round(p_retailprice / 4, 2)", "part")
_column_query("bool_to_string", {"size": "p_size"}, lambda: typed.bool_to_string(F.col("p_size") > 10), "CAST(p_size > 10 AS VARCHAR)", "part")


@register("derive_measures", """SELECT DISTINCT "State Bottle Retail" AS retail, "Bottles Sold" AS items, "Bottle Volume (ml)" AS ml,
  round("State Bottle Retail" * "Bottles Sold", 2) AS sale_dollars, round(round("State Bottle Retail" * "Bottles Sold", 2) * 36, 2) AS sale_baht,
  CAST("Bottle Volume (ml)" AS BIGINT) * "Bottles Sold" / 1000 AS liters FROM sales""")
def derive_measures(spark, sf_dir):
    lines = sales(spark, sf_dir)
    done = typed.derive_measures(lines, "State Bottle Retail", "Bottles Sold", "Bottle Volume (ml)")
    return done.select(
        F.col("State Bottle Retail").alias("retail"), F.col("Bottles Sold").alias("items"), F.col("Bottle Volume (ml)").alias("ml"),
        F.col("Sale Dollars").alias("sale_dollars"), F.col("Sale Baht").alias("sale_baht"), F.col("Volume Sold Liters").alias("liters"),
    ).distinct()


# Projection, filters, nulls, duplicates, sorting.


@register("project", 'SELECT "Invoice/Item Number" AS line, "Store Number" AS store, "Bottles Sold" * 2 AS twice FROM sales')
def project(spark, sf_dir):
    feed = sales(spark, sf_dir).withColumnsRenamed({"Invoice/Item Number": "line", "Store Number": "store"})
    return feed.withColumn("twice", F.col("Bottles Sold") * 2).select("line", "store", "twice")


@register("filter_changed", 'SELECT "Store Number" AS store, "County Number" AS county FROM sales WHERE "Store Number" <> "County Number"')
def filter_changed(spark, sf_dir):
    pairs = sales(spark, sf_dir).select(F.col("Store Number").alias("store"), F.col("County Number").alias("county"))
    return relational.filter_changed(pairs, "store", "county")


def _nullable(spark, sf_dir):
    return sales(spark, sf_dir).select(
        F.col("Invoice/Item Number").alias("line"), F.col("Address").alias("address"), F.col("County Number").alias("county")
    )


_NULLABLE = 'SELECT "Invoice/Item Number" AS line, "Address" AS address, "County Number" AS county FROM sales'


@register("drop_null_any", _NULLABLE + ' WHERE "Address" IS NOT NULL AND "County Number" IS NOT NULL')
def drop_null_any(spark, sf_dir):
    return relational.drop_null_any(_nullable(spark, sf_dir), ["address", "county"])


@register("drop_null_all", _NULLABLE + ' WHERE "Address" IS NOT NULL OR "County Number" IS NOT NULL')
def drop_null_all(spark, sf_dir):
    return relational.drop_null_all(_nullable(spark, sf_dir), ["address", "county"])


@register("distinct_rows", 'SELECT DISTINCT "City" AS city, "County" AS county FROM sales')
def distinct_rows(spark, sf_dir):
    return relational.distinct_rows(sales(spark, sf_dir).select(F.col("City").alias("city"), F.col("County").alias("county")))


@register("sort_output", "SELECT c_nationkey AS nation, c_custkey AS store, c_name AS name FROM customer ORDER BY 1, 2, 3")
def sort_output(spark, sf_dir):
    rows = _read(spark, sf_dir, "customer").selectExpr("c_nationkey AS nation", "c_custkey AS store", "c_name AS name")
    return relational.sort_output(rows, "nation", "store")


@register("drop_null_duplicates", """SELECT DISTINCT store, county FROM (SELECT "Store Number" AS store, "County Number" AS county,
  count("County Number") OVER (PARTITION BY "Store Number") AS n FROM sales) WHERE county IS NOT NULL OR n = 0""")
def drop_null_duplicates(spark, sf_dir):
    rows = sales(spark, sf_dir).select(F.col("Store Number").alias("store"), F.col("County Number").alias("county")).distinct()
    return relational.drop_null_duplicates(rows, "county", ["store"])


# Joins.

_BRIDGE = "SELECT CAST(c_custkey AS INT) AS a, CAST(c_custkey - c_custkey % 4 AS INT) AS b FROM customer WHERE c_custkey % 4 <> 0"


def _bridged(spark, sf_dir, how):
    lines = sales(spark, sf_dir).select(F.col("Invoice/Item Number").alias("line"), F.col("Store Number").cast("string").alias("store"))
    bridge = _read(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS INT) AS a", "CAST(c_custkey - c_custkey % 4 AS INT) AS b").filter("a <> b")
    return relational.apply_bridge(lines, bridge, "store", "a", "b", how)


@register("bridge_rewrite", f'SELECT "Invoice/Item Number" AS line, CAST(coalesce(b, "Store Number") AS VARCHAR) AS store FROM sales LEFT JOIN ({_BRIDGE}) ON "Store Number" = a')
def bridge_rewrite(spark, sf_dir):
    return _bridged(spark, sf_dir, "left")


@register("bridge_inner", f'SELECT "Invoice/Item Number" AS line, CAST(b AS VARCHAR) AS store FROM sales JOIN ({_BRIDGE}) ON "Store Number" = a')
def bridge_inner(spark, sf_dir):
    return _bridged(spark, sf_dir, "inner")


@register("unmatched_rows", f'SELECT o_orderkey AS line, CAST(o_custkey AS INT) AS store FROM orders WHERE o_custkey NOT IN (SELECT a FROM ({_BRIDGE}))')
def unmatched_rows(spark, sf_dir):
    lines = _read(spark, sf_dir, "orders").selectExpr("o_orderkey AS line", "CAST(o_custkey AS INT) AS store")
    bridge = _read(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS INT) AS a").filter("a % 4 <> 0")
    return relational.unmatched_rows(lines, bridge, "store", "a")


@register("join_using_one", "SELECT o_orderkey AS line, c_name AS name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def join_using_one(spark, sf_dir):
    lines = _read(spark, sf_dir, "orders").selectExpr("o_orderkey AS line", "o_custkey AS k")
    return lines.join(_read(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name AS name"), "k", "left").select("line", "name")


@register("join_using_many", """SELECT l_orderkey AS line, n FROM lineitem LEFT JOIN
  (SELECT l_partkey AS p, l_suppkey AS s, count(*) AS n FROM lineitem WHERE l_partkey % 2 = 0 GROUP BY 1, 2) ON l_partkey = p AND l_suppkey = s""")
def join_using_many(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS line", "l_partkey AS p", "l_suppkey AS s")
    counts = lines.filter("p % 2 = 0").groupBy("p", "s").agg(F.count(F.lit(1)).alias("n"))
    return lines.join(counts, ["p", "s"], "left").select("line", "n")


# Modes, ranges, numbering.


_NAMED = '(SELECT "Store Number" AS store, "Address" AS address, "County Number" AS county, "City" AS city, "Date" AS day FROM sales)'


def _named(spark, sf_dir):
    return sales(spark, sf_dir).select(
        F.col("Store Number").alias("store"), F.col("Address").alias("address"), F.col("County Number").alias("county"), F.col("City").alias("city"), F.col("Date").alias("day")
    )


@register("mode_single", f"SELECT * FROM {sql.mode_sql('store', 'address', _NAMED, 'address')}")
def mode_single(spark, sf_dir):
    return modes.mode_of(_named(spark, sf_dir), ["store"], "address", "address")


@register("mode_multi", f"SELECT * FROM {sql.mode_sql('city', 'address', _NAMED, 'address')} JOIN {sql.mode_sql('city', 'county', _NAMED, 'county')} USING (city)")
def mode_multi(spark, sf_dir):
    return modes.modes_of(_named(spark, sf_dir), ["city"], {"address": "address", "county": "county"})


@register("canonical_by_mode", f"SELECT s.store, s.day, m.address FROM {_NAMED} s LEFT JOIN {sql.mode_sql('store', 'address', _NAMED, 'address')} m USING (store)")
def canonical_by_mode(spark, sf_dir):
    return modes.canonical_by_mode(_named(spark, sf_dir).select("store", "address", "day"), ["store"], "address").select("store", "day", "address")


@register("date_range", f"SELECT store, address, min(day) AS first_day, max(day) AS last_day FROM {_NAMED} GROUP BY 1, 2")
def date_range(spark, sf_dir):
    return history.date_range(_named(spark, sf_dir), ["store", "address"], "day", "day", "first_day", "last_day")


@register("generate_id", "SELECT CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS n, event_id FROM events")
def generate_id(spark, sf_dir):
    return numbering.generate_id(_read(spark, sf_dir, "events").select("ts", "event_id"), ["ts", "event_id"], "n").select("n", "event_id")


@register("fill_null_ids", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN (SELECT max(event_id) FROM events WHERE event_id % 3 <> 0)
  + row_number() OVER (PARTITION BY event_id % 3 = 0 ORDER BY event_id) ELSE event_id END AS id FROM events""")
def fill_null_ids(spark, sf_dir):
    rows = _read(spark, sf_dir, "events").selectExpr("event_id", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS id")
    return numbering.fill_null_ids(rows, "id")


_EVENTS = "(SELECT user_id, ts, event_id FROM events)"


def _events(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("user_id", "ts", "event_id")


@register("occurrence_seq", f"SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS n FROM {_EVENTS}")
def occurrence_seq(spark, sf_dir):
    return numbering.occurrence(_events(spark, sf_dir), ["user_id"], "ts", "n").select("user_id", "event_id", "n")


@register("most_recent_flag", f"SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AS latest FROM {_EVENTS}")
def most_recent_flag(spark, sf_dir):
    return numbering.most_recent_flag(_events(spark, sf_dir), ["user_id"], "ts", "latest").select("event_id", "latest")


@register("keep_latest", f"SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {_EVENTS}) WHERE rn = 1")
def keep_latest(spark, sf_dir):
    return numbering.keep_latest(_events(spark, sf_dir), ["user_id"], "ts").select("user_id", "event_id")


# Table jobs.


class Jobs:
    """The tables of the jobs over one feed, each built once and written; item tuples come of the lines, store tuples of the orders."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: Iterable[str] = tuple(JOBS)):
        """``tables`` are the ones that will be asked for; the scan takes no more of the feed than they need."""
        self.feed = sales(spark, sf_dir)
        self.spark, self.sf_dir, self.built, self.wanted = spark, sf_dir, {}, tuple(tables)

    @cached_property
    def tuples(self) -> dict[str, DataFrame]:
        written, ranged = {}, ranged_families(self.wanted)
        for family, columns in families_of(self.wanted).items():
            feed = self.feed if family == "items" else places(self.spark, self.sf_dir, FAMILIES["stores"])
            path = new_folder(self.spark, "tuples")
            own([path])
            written |= write_tuples(feed, path, {family: columns}, family in ranged)
        return written

    def plan(self, name: str) -> DataFrame:
        """A table as it is computed, in no order; the tables it needs are written first."""
        job = JOBS[name]
        return job.build(self.tuples[job.family], *[self.table(n) for n in job.needs])

    def table(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = materialize(self.plan(name), name)
        return self.built[name]

    def delivered(self, name: str) -> DataFrame:
        """A table in its order.  What reads a table as an input or a file leaves the order out."""
        return JOBS[name].ordered(self.plan(name))

    def fact(self, asof: bool = False) -> DataFrame:
        if asof:
            return self.fact_asof(self.feed)
        return fact.build_fact(self.feed, *[self.table(n) for n in FACT_INPUTS])

    def fact_asof(self, feed: DataFrame) -> DataFrame:
        """The as-of fact of ``feed``, which is ``self.feed`` with or without more columns."""
        days = places(self.spark, self.sf_dir, ["Store Number", "Address", "Date"])
        return fact.build_fact_asof(feed, *[self.table(n) for n in ASOF_INPUTS], places=days)


def _job(name: str, ctes: str, select: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _snake(Jobs(spark, sf_dir, (name,)).delivered(name))

    QUERIES[name] = query
    ORACLES[name] = sql.with_sales(ctes, select) if ctes else f"WITH sales AS ({sales_sql()}) {select}"


_ITEMS, _STORES = f"{sql.TUPLES}, {sql.ITEM_BRIDGE}", sql.STORE_BRIDGE
_job("category", "", sql.CATEGORY)
_job(
    "vendor",
    f"""cleaned AS (SELECT {sql.VENDOR} AS number, {sql.case_sql("name", rules.VENDOR_NAME)} AS name FROM (SELECT *, upper({sql.CLEAN.format('"Vendor Name"')}) AS name FROM sales)),
  usual AS {sql.mode_sql("number", "name", "(SELECT * FROM cleaned WHERE number IS NOT NULL)", "name")},
  loose AS (SELECT DISTINCT name FROM cleaned WHERE number IS NULL AND name NOT IN (SELECT name FROM cleaned WHERE number IS NOT NULL))""",
    """SELECT 'VEN_' || number AS vendor_number, name AS vendor_name FROM usual UNION ALL
  SELECT 'VEN_' || ((SELECT max(number) FROM usual) + row_number() OVER (ORDER BY name)), name FROM loose""",
)
_job("store_county", "", f"""SELECT DISTINCT 'CNT_' || "County Number" AS county_number, {sql.case_sql('upper("County")', rules.COUNTY_NAME)} AS county_name FROM sales WHERE "County Number" IS NOT NULL""")
_job("item_number_bridge", _ITEMS, "SELECT * FROM item_bridge")
_job("item_vendor_bridge", f"{sql.TUPLES}, {sql.ITEM_PAIRS}", "SELECT * FROM item_pairs")
_job("item_price_history", f"{_ITEMS}, {sql.price_ctes()}", sql.PRICES_SELECT)
_job("item_vendor_price_history", f"{sql.TUPLES}, {sql.ITEM_ONES}, {sql.price_ctes(True)}", sql.PRICES_SELECT)
_job("item", f"{_ITEMS}, {sql.ITEM}", sql.ITEM_SELECT)
_job("store_number_bridge", _STORES, "SELECT * FROM store_bridge")
_job("store_site_bridge", sql.STORE_PAIRS, "SELECT original_store_number, site, current_store_number FROM store_pairs")
_job("store_address_history", f"{_STORES}, {sql.history_ctes()}", "SELECT * FROM history")
_job("store_site_history", f"{sql.STORE_PAIRS}, {sql.history_ctes(True)}", "SELECT * FROM history")
_job("store_address", f"{_STORES}, {sql.STORE_ADDRESS}", sql.STORE_ADDRESS_SELECT)


@register("store_address_bridge", f"""SELECT DISTINCT upper("Address") AS original_address, {sql.address_sql('"Address"')} AS current_address FROM sales WHERE "Address" IS NOT NULL""")
def store_address_bridge(spark, sf_dir):
    return _snake(Jobs(spark, sf_dir, ("store_address_bridge",)).delivered("store_address_bridge").dropna())


@register("fact_invoice")
def fact_invoice(spark, sf_dir):
    return _snake(Jobs(spark, sf_dir, FACT_INPUTS).fact())


@register("fact_invoice_asof")
def fact_invoice_asof(spark, sf_dir):
    return _snake(Jobs(spark, sf_dir, ASOF_INPUTS).fact(asof=True))


ORACLES |= {"fact_invoice": sql.FACT, "fact_invoice_asof": sql.FACT_ASOF}


@register("bridge_conflicts")
def bridge_conflicts(spark, sf_dir):
    """What a bridge without its scope leaves open: the old numbers with several current ones, of both kinds."""
    jobs, found = Jobs(spark, sf_dir, ("item_number_bridge", "store_number_bridge")), []
    for kind, name in (("item", "item_number_bridge"), ("store", "store_number_bridge")):
        bridge = jobs.table(name).toDF("original", "current")
        found.append(bridges.bridge_conflicts(bridge, ["original"], "current").select(F.lit(kind).alias("kind"), "*"))
    return found[0].unionByName(found[1])


_CONFLICTS = "SELECT '{0}' AS kind, original_{0}_number AS original, count(*) AS n_current, min(current_{0}_number) AS lowest, max(current_{0}_number) AS highest FROM {0}_bridge GROUP BY 2 HAVING count(*) > 1"
ORACLES["bridge_conflicts"] = sql.with_sales(f"{_ITEMS}, {_STORES}", f"{_CONFLICTS.format('item')} UNION ALL {_CONFLICTS.format('store')}")


@register("line_report")
def line_report(spark, sf_dir):
    """Per month, the lines of the feed and of the as-of fact: what the address join dropped."""
    jobs = Jobs(spark, sf_dir, ASOF_INPUTS)
    feed = months.with_months(jobs.feed)
    return _snake(fact.line_report(feed, jobs.fact_asof(feed)))


ORACLES["line_report"] = sql.LINE_REPORT


@register("geo_mode")
def geo_mode(spark, sf_dir):
    """The usual coordinates of every store and city, with the days it was seen there."""
    rows = stores.with_coordinates(sales(spark, sf_dir).select("Store Number", "City", "Store Location", "Date"))
    return _snake(modes.modes_of(
        rows, ["Store Number", "City"], {"Latitude": "Latitude", "Longitude": "Longitude"}, lows={"From Date": "Date"}, highs={"To Date": "Date"}
    ))


ORACLES["geo_mode"] = sql.GEO_MODE


@register("load_tables", """SELECT 'store_county' AS loaded, "County Number" AS key, count(*) AS n FROM (SELECT DISTINCT 'CNT_' || "County Number" AS "County Number" FROM sales WHERE "County Number" IS NOT NULL) GROUP BY 2
  UNION ALL SELECT 'sales_feed', CAST("Store Number" AS VARCHAR), count(*) FROM sales GROUP BY 2""")
def load_tables(spark, sf_dir):
    """A CSV table and a Parquet table, loaded by name with their declared schemas."""
    jobs, folder = Jobs(spark, sf_dir, ("store_county",)), new_folder(spark, "loaded")
    dated = jobs.feed.withColumn("Date", F.date_format("Date", rules.FEED_DATE_FORMAT))
    files.write_table(dated, f"{folder}/feed", format="csv")
    files.write_table(jobs.plan("store_county"), f"{folder}/county")
    loaded = files.load_tables(spark, {"sales_feed": (f"{folder}/feed", "csv"), "store_county": (f"{folder}/county", "parquet")})
    keys = {"sales_feed": F.col("Store Number").cast("string"), "store_county": F.col("County Number")}
    counts = [
        df.select(keys[name].alias("key")).distinct() if name == "store_county" else df.select(keys[name].alias("key")) for name, df in loaded.items()
    ]
    named = [c.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("loaded"), "key", "n") for name, c in zip(loaded, counts, strict=True)]
    return named[0].unionByName(named[1])


def _reconcile(table: str, query: str, oracle: str) -> None:
    """The published table through its export and back, as the reconciliation reads it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        names = reconcile.export_schema(table).names
        folder = new_folder(spark, "export")
        # What an export was made from goes once it is written, and the export once it is read.
        with scratch(spark):
            rows = Jobs(spark, sf_dir, (query,)).plan(query) if query in JOBS else QUERIES[query](spark, sf_dir)
            if query == "store_address_bridge":
                rows = rows.dropna()
            reconcile.export_table(table, rows.toDF(*names), f"{folder}/csv")
        reconcile.reconcile_file(spark, table, f"{folder}/csv", f"{folder}/parquet")
        drop_folders(spark, [f"{folder}/csv"])
        return _snake(spark.read.parquet(f"{folder}/parquet"))

    register(f"reconcile_{table}")(run)
    ORACLES[f"reconcile_{table}"] = oracle


for _table in ("category", "vendor", "store_county", "item_number_bridge", "store_address_bridge", "store_number_bridge", "store_address"):
    _reconcile(_table, _table, ORACLES[_table])

# Dates go out 543 years ahead and come back, money is rounded, flags become text.
_FLAG, _MONEY = "CAST(is_current AS VARCHAR) AS is_current", "round({0}, 2) AS {0}"
_COST, _RETAIL = _MONEY.format("state_bottle_cost"), _MONEY.format("state_bottle_retail")
_reconcile("item", "item", f"SELECT * REPLACE ({_COST}, {_RETAIL}) FROM ({ORACLES['item']})")
_reconcile("item_price_history", "item_price_history", f"SELECT * REPLACE ({_COST}, {_RETAIL}, {_FLAG}) FROM ({ORACLES['item_price_history']})")
_reconcile("store_address_history", "store_address_history", f"SELECT * REPLACE ({_FLAG}) FROM ({ORACLES['store_address_history']})")
_reconcile("invoice", "fact_invoice_asof", ORACLES["fact_invoice_asof"])


# Sources and sinks, round-tripped through a fresh folder.

_ORDERS = "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS \"Date\" FROM orders"


def _dated(spark, sf_dir):
    return _read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "CAST(o_orderdate AS DATE) AS Date")


@register("scan_csv", "SELECT * FROM customer")
def scan_csv(spark, sf_dir):
    rows, path = _read(spark, sf_dir, "customer"), new_folder(spark, "csv")
    rows.write.option("header", True).csv(path)
    return files.read_data(spark, path, schema=rows.schema)


@register("scan_parquet", "SELECT p_partkey, p_name FROM part")
def scan_parquet(spark, sf_dir):
    tune(spark)
    return files.read_data(spark, f"{sf_dir}/part.parquet", format="parquet", schema="p_partkey bigint, p_name string")


@register("write_table", "SELECT * FROM supplier")
def write_table(spark, sf_dir):
    path = new_folder(spark, "table")
    files.write_table(_read(spark, sf_dir, "supplier"), path)
    return spark.read.parquet(path)


@register("partition_by_month", f'SELECT *, CAST(year("Date") AS INT) AS "Year", CAST(month("Date") AS INT) AS "Month" FROM ({_ORDERS})')
def partition_by_month(spark, sf_dir):
    path = new_folder(spark, "months")
    months.partition_by_month(_dated(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("scan_month", f'SELECT o_orderkey, o_custkey, "Date" FROM ({_ORDERS}) WHERE year("Date") = 1996 AND month("Date") = 3')
def scan_month(spark, sf_dir):
    path = new_folder(spark, "months")
    months.partition_by_month(_dated(spark, sf_dir), path)
    return months.read_month(spark, path, 1996, 3).select("o_orderkey", "o_custkey", "Date")


@register("write_month", f'SELECT o_orderkey, o_custkey, "Date", CAST(year("Date") AS INT) AS "Year", CAST(month("Date") AS INT) AS "Month" FROM ({_ORDERS}) WHERE month("Date") <> 2 OR o_orderkey % 2 = 0')
def write_month(spark, sf_dir):
    """All months, then every February again with half of its rows: the others survive."""
    path = new_folder(spark, "fact")
    rows = months.with_months(_dated(spark, sf_dir))
    months.write_months(rows, path, sort_by=["Date", "o_orderkey"])
    months.write_months(rows.filter("Month = 2 AND o_orderkey % 2 = 0"), path, sort_by=["Date", "o_orderkey"])
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "Date", "Year", "Month")


def _table_name() -> str:
    import uuid

    return f"publish_{uuid.uuid4().hex}"


@register("publish_append", "SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey, r_name FROM region")
def publish_append(spark, sf_dir):
    rows, table = _read(spark, sf_dir, "region"), _table_name()
    path = new_folder(spark, "published")
    publish.publish_append(rows, table, path)
    publish.publish_append(rows, table, path)
    return spark.table(table)


@register("publish_replace", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey <> 3 OR c_custkey <= 100")
def publish_replace(spark, sf_dir):
    """All nations, then one of them again with some of its rows: the others survive."""
    rows, table = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), _table_name()
    publish.publish_replace(rows, table, ["c_nationkey"], new_folder(spark, "published"))
    publish.publish_replace(rows.filter("c_nationkey = 3 AND c_custkey <= 100"), table, ["c_nationkey"])
    return spark.table(table)


# Progress of the monthly feed, over the months of the orders.


def _progress(spark, sf_dir, condition: str):
    found = _read(spark, sf_dir, "orders").selectExpr("year(o_orderdate) AS year", "month(o_orderdate) AS month").distinct()
    return found.filter(condition).selectExpr("'invoice' AS kind", "year", "month", "'File Created' AS status")


_MONTHS = "SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders"


@register("backfill_plan", f"SELECT * FROM ({_MONTHS}) WHERE month % 5 = 0")
def backfill_plan(spark, sf_dir):
    expected = _progress(spark, sf_dir, "true").select("year", "month")
    return incremental.backfill_plan(expected, _progress(spark, sf_dir, "month % 5 <> 0").select("year", "month"))


@register("upsert_checkpoint", f"SELECT 'invoice' AS kind, year, month, CASE WHEN month % 5 = 0 THEN 'NOT UPLOADED' ELSE 'File Created' END AS status FROM ({_MONTHS})")
def upsert_checkpoint(spark, sf_dir):
    old = _progress(spark, sf_dir, "true")
    failed = _progress(spark, sf_dir, "month % 5 = 0").withColumn("status", F.lit("NOT UPLOADED"))
    return incremental.upsert_checkpoint(old, failed.unionByName(failed)).select("kind", "year", "month", "status")


@register("latest_checkpoint", f"SELECT year, month FROM ({_MONTHS}) WHERE month % 5 <> 0 ORDER BY year DESC, month DESC LIMIT 1")
def latest_checkpoint(spark, sf_dir):
    return incremental.latest_checkpoint(_progress(spark, sf_dir, "month % 5 <> 0"), "invoice")


@register("next_month", f"SELECT CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month FROM (SELECT max(make_date(year, month, 1)) + INTERVAL 1 MONTH AS d FROM ({_MONTHS}))")
def next_month(spark, sf_dir):
    return incremental.next_month(_progress(spark, sf_dir, "true"), "invoice")


@register("backfill_list", f"SELECT year, month FROM ({_MONTHS}) WHERE month % 5 = 0")
def backfill_list(spark, sf_dir):
    return incremental.backfill_list(upsert_checkpoint(spark, sf_dir), "invoice")


# Deliveries, batches, and the fact that follows them, over the orders.

_ORDER_DAYS = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS "Date" FROM orders"""


def _deliveries(spark, sf_dir) -> dict[str, DataFrame]:
    """The orders in three deliveries: two by year, and a late one with some orders of every month."""
    rows = _read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "o_totalprice", "CAST(o_orderdate AS DATE) AS Date")
    late = F.col("o_orderkey") % 7 == 0
    first = F.year("Date") < 1995
    return {"early": rows.filter(~late & first), "recent": rows.filter(~late & ~first), "late": rows.filter(late)}


def orders_by_customer(feed: DataFrame) -> DataFrame:
    """A monthly fact of the orders: a row per month and customer."""
    return feed.groupBy(*months.MONTH, "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"), F.max("Date").alias("last_day")
    )


_BY_CUSTOMER = f"""SELECT CAST(year("Date") AS INT) AS "Year", CAST(month("Date") AS INT) AS "Month", o_custkey, count(*) AS n,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, max("Date") AS last_day FROM ({_ORDER_DAYS}) GROUP BY 1, 2, 3"""


@register("land_append", f'SELECT *, CAST(year("Date") AS INT) AS "Year", CAST(month("Date") AS INT) AS "Month" FROM ({_ORDER_DAYS})')
def land_append(spark, sf_dir):
    """Months that grow by late orders; a delivery that comes again, and one that comes wrong first, leave no copy."""
    root, parts = new_folder(spark, "landing"), _deliveries(spark, sf_dir)
    landing.land(parts["early"].unionByName(parts["late"]), root, "recent")
    for name in ("early", "recent", "late", "early"):
        landing.land(parts[name], root, name)
    return landing.read_landed(spark, root)


@register("publish_batch", _ORDER_DAYS)
def publish_batch(spark, sf_dir):
    """Batches by name, one of them twice: one copy of each."""
    root, parts = new_folder(spark, "published"), _deliveries(spark, sf_dir)
    for name in ("early", "late", "early", "recent"):
        landing.publish_batch(parts[name], root, name)
    return landing.read_published(spark, root)


@register("monthly_feed", _BY_CUSTOMER)
def monthly_feed(spark, sf_dir):
    """Two deliveries with some months marked as failed, then the late one: the second run takes the changed months."""
    root, facts, parts = new_folder(spark, "landing"), new_folder(spark, "facts"), _deliveries(spark, sf_dir)
    store = incremental.new_store(spark)
    store.upsert(_progress(spark, sf_dir, "year = 1993 AND month % 6 = 0").withColumn("status", F.lit(incremental.NOT_UPLOADED)))
    for names in (("early", "recent"), ("late",)):
        for name in names:
            landing.land(parts[name], root, name)
        incremental.monthly_feed(spark, root, facts, orders_by_customer, store, batch=100)
    return incremental.read_fact(spark, facts, store)


@register("feed_stream", _BY_CUSTOMER)
def feed_stream(spark, sf_dir):
    """Three deliveries, one late, worked off by two runs of the stream from one checkpoint."""
    root, facts, parts = new_folder(spark, "landing"), new_folder(spark, "facts"), _deliveries(spark, sf_dir)
    store, checkpoint = incremental.new_store(spark), new_folder(spark, "stream")
    for names in (("early", "recent"), ("late",)):
        for name in names:
            landing.land(parts[name], root, name)
        feed.feed_stream(spark, root, facts, orders_by_customer, store, checkpoint).awaitTermination()
    return incremental.read_fact(spark, facts, store)


@register("progress_store", f"""SELECT 'invoice' AS kind, year, month, CASE WHEN month % 5 = 0 THEN 'NOT UPLOADED' ELSE 'File Created' END AS status FROM ({_MONTHS})
  UNION ALL SELECT 'gcs', year, month, 'UPLOADED' FROM ({_MONTHS}) WHERE month % 5 <> 0""")
def progress_store(spark, sf_dir):
    """Two kinds of progress in one store: all months, then the failed ones, then what was sent on."""
    store = incremental.new_store(spark)
    store.upsert(_progress(spark, sf_dir, "true"))
    store.upsert(_progress(spark, sf_dir, "month % 5 = 0").withColumn("status", F.lit(incremental.NOT_UPLOADED)))
    store.upsert(_progress(spark, sf_dir, "month % 5 <> 0").withColumns({"kind": F.lit("gcs"), "status": F.lit(incremental.UPLOADED)}))
    return store.read().select("kind", "year", "month", "status")
