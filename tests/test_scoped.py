"""Scoped bridges, the as-of join on binned days, the one-scan refresh."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillworks import queries
from tillworks.adapter import places, sales
from tillworks.operators import numbering
from tillworks.operators.bridges import bridge_conflicts, rewrite_scoped
from tillworks.operators.intervals import asof_join
from tillworks.plans import fact, items, refresh, stores
from tillworks.plans.tuples import FAMILIES, FIRST, LAST, LINES, write_tuples

DATA = "/root/testdata/sf0.001"
RANGE = "store string, address string, low date, high date, seq int"


def day(n):
    return dt.date(2015, 12, 25) + dt.timedelta(days=n)


def test_asof_join_by_brute_force(spark):
    draw = random.Random(2)
    ranges = [(draw.choice("abc"), draw.choice("xy"), day(a), day(a + draw.randrange(-1, 90)), i) for i, a in enumerate(draw.randrange(200) for _ in range(60))]
    ranges += [("a", "x", None, day(9), 100), ("a", "x", day(9), None, 101), (None, "x", day(0), day(300), 102), ("a", "x", day(40), day(40), 103)]
    lines = [(i, draw.choice(["a", "b", "c", "d", None]), draw.choice(["x", "y"]), day(draw.randrange(-5, 320))) for i in range(800)]
    lines += [(900, "a", "x", None), (901, "a", "x", day(40)), (901, "a", "x", day(40))]
    got = asof_join(spark.createDataFrame(lines, "line int, store string, address string, at date"), spark.createDataFrame(ranges, RANGE),
                    ["store", "address"], "at", "low", "high", "seq").collect()
    fits = lambda s, a, d: [q for rs, ra, lo, hi, q in ranges if rs == s and ra == a and s and d and lo and hi and lo <= d <= hi]
    want = [(i, s, a, d, max(fits(s, a, d), default=None)) for i, s, a, d in lines]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(len(fits(s, a, d)) > 2 for _, s, a, d in lines)


def test_asof_join_plan_has_no_range_condition(spark):
    lines = spark.createDataFrame([(1, "a", "x", day(0))], "line int, store string, address string, at date")
    joined = asof_join(lines, spark.createDataFrame([("a", "x", day(0), day(1), 1)], RANGE), ["store", "address"], "at", "low", "high", "seq")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "<=" not in join and ">=" not in join


def test_fact_asof_has_one_row_per_distinct_line(spark):
    """Every line of the feed comes twice, and every place has overlapping ranges."""
    jobs = queries.Jobs(spark, DATA)
    feed = jobs.feed.unionByName(jobs.feed)
    inputs = {n: jobs.table(n) for n in refresh.ASOF_INPUTS}
    later = inputs["store_site_history"].withColumn("Address Sequence", F.col("Address Sequence") + 1000)
    inputs["store_site_history"] = inputs["store_site_history"].unionByName(later)
    built = fact.build_fact_asof(feed, *inputs.values())
    known = jobs.feed.filter(F.col("Address").isNotNull()).count()
    assert built.count() == known == built.distinct().count()
    assert built.filter("`Address Sequence` <= 1000").isEmpty() and not built.filter("`Address Sequence` > 1000").isEmpty()


def test_scoped_rewrite_never_adds_rows(spark):
    lines = spark.createDataFrame([("7", "A"), ("007", "A"), ("7", "B"), ("7", None), ("x", "A"), (None, "A"), ("9", "A")], "item string, vendor string")
    bridge = spark.createDataFrame([(7, "A", 3), (7, "A", 2), (7, "B", 5), (8, "A", 1), (None, "A", 1)], "old int, vendor string, new int")
    got = rewrite_scoped(lines, bridge, "item", "old", "new", {"vendor": "vendor"}).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("2", "A"), ("2", "A"), ("5", "B"), ("7", None), ("x", "A"), (None, "A"), ("9", "A")]))
    assert list(map(tuple, bridge_conflicts(bridge, ["old", "vendor"], "new").collect())) == [(7, "A", 2, 2, 3)]


def test_refresh_scans_the_feed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    feed = sales(spark, DATA)
    n = feed.count()

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    built = refresh.refresh(feed.mapInArrow(count, feed.schema), str(tmp_path))
    assert set(built) == set(refresh.JOBS) and seen.value == n


@pytest.mark.parametrize("table", ["item", "store_address_history"])
def test_tuples_give_the_tables_of_the_feed(spark, table):
    """Jobs over the feed itself give what they give over the tuples."""
    jobs = queries.Jobs(spark, DATA)
    job = refresh.JOBS[table]
    inputs = [jobs.table(n) for n in job.needs]
    direct, ours = job.build(jobs.feed, *inputs), job.build(jobs.tuples[job.family], *inputs)
    assert direct.exceptAll(ours).isEmpty() and ours.exceptAll(direct).isEmpty()
    assert not set(FAMILIES["items"]) & set(FAMILIES["stores"])


@pytest.mark.parametrize("table", ["vendor", "store_site_history", "store_address", "bridge_conflicts"])
def test_tuples_hold_only_what_the_tables_need(spark, table):
    """Fewer columns make fewer tuples: a query pays neither for the other family nor for days it does not count."""
    wanted = ("item_number_bridge", "store_number_bridge") if table == "bridge_conflicts" else (table,)
    jobs = queries.Jobs(spark, DATA, wanted)
    needed = {"items": set(), "stores": set()}
    for name in refresh.order_of(wanted):
        needed[refresh.JOBS[name].family].update(refresh.JOBS[name].columns)
    needed = {family: columns for family, columns in needed.items() if columns}
    assert {family: set(df.columns) - {LINES, FIRST, LAST} for family, df in jobs.tuples.items()} == needed
    for family, columns in needed.items():
        assert jobs.tuples[family].count() == jobs.feed.select(*columns).distinct().count()
        assert jobs.tuples[family].agg(F.sum(LINES)).first()[0] == jobs.feed.count()
    everything = queries.Jobs(spark, DATA)
    for name in set(wanted):
        ours, theirs = jobs.plan(name), everything.plan(name)
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


@pytest.mark.parametrize("many", [2, 100])
def test_unfolded_items_are_dealt_before_they_are_many(spark, monkeypatch, many):
    """What groups by item and vendor needs no shuffle after the bridge; a large vendor gives the same rows."""
    monkeypatch.setattr(items, "MANY_TUPLES", many)
    rows = spark.createDataFrame([("7", "A", 1), ("007", "A", 2), ("8", "A", 3), ("7", None, 4), (None, "B", 5), ("x", "B", 6)], "`Item Number` string, `Vendor Number` string, n int")
    bridge = spark.createDataFrame([(7, 3), (7, 2), (8, 1)], "`Original Item Number` int, `Current Item Number` int")
    dealt = items._rewrite_by_vendor(rows, bridge)
    assert sorted(map(str, map(tuple, dealt.drop("_spread").collect()))) == sorted(map(str, map(tuple, items.rewrite_item(rows, bridge).collect())))
    plan = dealt.groupBy("Item Number", "Vendor Number", "_spread").count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(Item Number" not in plan and "REPARTITION_BY_NUM" in plan


def test_store_tuples_come_of_the_orders(spark, tmp_path):
    """Rows that come twice, null keys and orders without lines count as they do in the lines; only order keys of lines are moved."""
    for name in ("lineitem", "orders", "customer", "supplier", "part", "nation", "region"):
        rows = spark.read.parquet(f"{DATA}/{name}.parquet")
        key = rows.columns[0]
        kept = rows.filter(F.col(key) % 10 != 3) if name in ("lineitem", "part") else rows
        odd = rows.filter(F.col(key) % 7 == 1)
        kept.unionByName(odd).unionByName(odd.withColumn(key, F.lit(None).cast(rows.schema[key].dataType))).write.parquet(f"{tmp_path}/{name}.parquet")
    family = {"stores": FAMILIES["stores"]}
    ours = write_tuples(places(spark, str(tmp_path), FAMILIES["stores"]), f"{tmp_path}/ours", family)["stores"]
    theirs = write_tuples(sales(spark, str(tmp_path)), f"{tmp_path}/theirs", family)["stores"]
    assert ours.schema == theirs.schema and ours.count() > 0
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_address_patterns_run_once_per_raw_address(spark):
    feed = spark.createDataFrame([("1 N Main St.",), ("1 N Main St.",), (None,)], "Address string")
    plan = stores.build_store_address_bridge(feed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2


@pytest.mark.parametrize("scope", [[], ["Vendor Number"]])
def test_item_pairs_by_brute_force(spark, scope):
    draw = random.Random(4)
    rows = [(draw.choice(["7", "07", "8", "x9", "12", "a", None]), draw.choice(["Red ale", "Ale", None]), draw.choice([1, 2, None]), draw.choice(["Brewer", None])) for _ in range(80)]
    feed = spark.createDataFrame(rows, "`Item Number` string, `Item Description` string, `Vendor Number` int, `Vendor Name` string")
    clean = [(i and i.replace("x", ""), d and d.title().replace("Red ale", "Red Ale"), v) for i, d, v, _ in rows]
    usual = {}
    for item in {i for i, _, _ in clean}:
        votes = sorted((-sum(1 for i, e, _ in clean if (i, e) == (item, d)), d) for d in {d for i, d, _ in clean if i == item and d})
        usual[item] = votes[0][1] if votes else None
    numbers = {(i, v) for i, _, v in clean if i and v and usual[i]}
    lowest = {(i, v): min(j for j, w in numbers if w == v and usual[j] == usual[i]) for i, v in numbers}
    pairs = {(i, str(v), low) if scope else (i, low) for (i, v), low in lowest.items() if i != low}
    digits = lambda t: int(t) if t.isdigit() else None
    ids = [(digits(p[0]), *p[1:-1], digits(p[-1])) for p in pairs]
    want = [p for p in ids if p[0] is not None and p[-1] is not None and p[0] != p[-1]]
    built = items._renumbered(feed, scope)
    assert sorted(map(tuple, built.collect())) == sorted(want) and want


def test_asof_fact_looks_stores_up_by_day(spark):
    """Of all joins with store tables, the lines take part in one, and stores known without the lines give the same fact."""
    jobs = queries.Jobs(spark, DATA, refresh.ASOF_INPUTS)
    inputs = [jobs.table(n) for n in refresh.ASOF_INPUTS]
    ours, theirs = jobs.fact_asof(jobs.feed), fact.build_fact_asof(jobs.feed, *inputs)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    odd = jobs.feed.limit(50).withColumns({"Date": F.lit(None).cast("date"), "Invoice/Item Number": F.concat(F.lit("odd-"), "Invoice/Item Number")})
    for how in ("inner", "left"):
        built = fact.build_fact_asof(jobs.feed.unionByName(odd), *inputs, how=how).filter("`Invoice_Item Number` LIKE 'odd-%'")
        known = odd if how == "left" else odd.filter(F.col("Address").isNotNull())
        assert built.count() == known.count() > 0 and built.filter("`Address Sequence` IS NOT NULL").isEmpty()


def test_only_large_vendors_are_counted_by_item(spark, monkeypatch):
    monkeypatch.setattr(items, "MANY_TUPLES", 2)
    rows = spark.createDataFrame([("7", "A", 1), ("007", "A", 2), ("8", "A", 3), ("7", "B", 4), (None, "B", 5)], "`Item Number` string, `Vendor Number` string, n int")
    bridge = spark.createDataFrame([(7, "A", 3), (7, "B", 2)], "`Original Item Number` int, `Vendor Number` string, `Current Item Number` int")
    dealt = items._rewrite_by_vendor(rows, bridge)
    want = {("3", "A", 1, "3"), ("3", "A", 2, "3"), ("8", "A", 3, "8"), ("2", "B", 4, None), (None, "B", 5, None)}
    assert set(map(tuple, dealt.collect())) == want


@pytest.mark.parametrize("many,cut", [(2, 1), (2, 10), (100, 10)])
def test_price_rows_by_brute_force(spark, monkeypatch, many, cut):
    """However rows are dealt; slices follow the unfolded rows, so that a task's share does not grow with the tables."""
    monkeypatch.setattr(items, "MANY_TUPLES", many)
    monkeypatch.setattr(items, "ROWS_A_SLICE", cut)
    monkeypatch.setattr(items, "HEAVY_ROWS", 3)
    monkeypatch.setattr(numbering, "HEAVY_ROWS", 3)
    draw = random.Random(6)
    price = lambda: (draw.choice([1, None]), 750, draw.choice([1.0, None]), draw.choice([2.0, 3.0]))
    rows = [(draw.choice(["7", "007", "8", "9", "x", None]), draw.choice(["A", "B", None]), *price(), day(draw.randrange(9)), day(9 + draw.randrange(9))) for _ in range(60)]
    ranges = spark.createDataFrame(rows, "`Item Number` string, `Vendor Number` string, Pack int, `Bottle Volume ml` int, `State Bottle Cost` double, `State Bottle Retail` double, `From Date` date, `To Date` date")
    bridge = spark.createDataFrame([(7, 3), (7, 2), (7, 2), (8, 2), (9, 8), (None, 1)], "`Original Item Number` int, `Current Item Number` int")
    current = {"7": ["2", "3"], "007": ["2", "3"], "8": ["2"], "9": ["8"]}
    merged = {}
    for item, *shared, low, high in rows:
        for c in current.get(item, [item]):
            merged.setdefault((c, *shared), []).append((low, high))
    want = [(*k, min(r[0] for r in v), max(r[1] for r in v)) for k, v in merged.items()]
    found, heavy = items._price_rows(ranges, bridge)
    assert sorted(map(str, map(tuple, found.select(ranges.columns).collect()))) == sorted(map(str, want))
    assert found.rdd.getNumPartitions() >= len(rows) / cut
    plan = found.groupBy("Item Number", "Vendor Number", "_spread").count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(Item Number" not in plan
    crowded = max(sum(1 for w in want if w[:2] == key) for key in {w[:2] for w in want})
    assert crowded > 3 and not found.filter(heavy).isEmpty() if many == 2 else True


@pytest.mark.parametrize("many", [2, 20])
def test_items_are_described_before_they_are_unfolded(spark, monkeypatch, many):
    """Item rows meet what is known of them where they are dealt; large vendors, items without a list or a number give the same rows."""
    monkeypatch.setattr(items, "MANY_TUPLES", many)
    draw = random.Random(8)
    rows = [(draw.choice(["7", "007", "8", "9", "x", None]), draw.choice(["A", "B", None]), n) for n in range(80)]
    df = spark.createDataFrame(rows, "`Item Number` string, `Vendor Number` string, n int")
    bridge = spark.createDataFrame([(7, 3), (7, 2), (8, 2), (8, None), (9, 7)], "`Original Item Number` int, `Current Item Number` int")
    known = spark.createDataFrame([("2", "Ale", "CAT_1"), ("3", "Ale", "CAT_1"), ("7", "Rum", None), ("x", None, None)], "`Item Number` string, `Item Description` string, `Category Number` string")
    dealt = items._deal_described(df, bridge, known)
    plain = items.rewrite_item(df, bridge).join(known, "Item Number", "left").select(dealt.drop("_spread").columns)
    assert sorted(map(str, map(tuple, dealt.drop("_spread").collect()))) == sorted(map(str, map(tuple, plain.collect())))
    # A current item of a vendor is in one place, large vendors in several.
    assert dealt.groupBy("Item Number", "Vendor Number").agg(F.countDistinct(F.coalesce("_spread", F.lit("none"))).alias("n")).filter("n > 1").isEmpty()
    plan = dealt.groupBy("Item Number", "Vendor Number", "_spread").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.rfind("REPARTITION_BY_NUM") >= 0 and "Exchange" not in plan[: plan.find("REPARTITION_BY_NUM")].replace("Exchange hashpartitioning(Vendor Number", "")


def test_fact_rows_are_distinct_before_they_are_many(spark):
    """Lines alike in all but items and prices share their rows; no operator compares the unfolded rows."""
    schema = "inv string, `Item Number` string, `Price Sequence` int, _items array<string>, _prices array<struct<`Item Number`:string,`Price Sequence`:int>>"
    rows = [("a", None, None, ["1", "2", "2"], [("1", 5), ("1", 6), ("9", 7)]), ("a", None, None, ["2", "3"], None), ("a", None, None, ["2", "3"], None),
            (None, None, None, [None, "4"], [("4", 1)]), (None, None, None, [None], None)]
    built = fact._distinct_rows(spark.createDataFrame(rows, schema).drop("Item Number", "Price Sequence"), ["inv", "Item Number", "Price Sequence"])
    want = [("a", "1", 5), ("a", "1", 6), ("a", "2", None), ("a", "3", None), (None, None, None), (None, "4", 1)]
    assert sorted(map(str, map(tuple, built.collect()))) == sorted(map(str, want))
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert plan.find("Generate explode") < plan.find("Aggregate")
