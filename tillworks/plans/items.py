"""Item tables: number bridge, price history, item dimension.

Each job first reduces the feed to distinct attribute tuples with a line count
and dates.  That aggregation combines map-side; what follows works on tuples.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks import rules
from tillworks.functions import text, values
from tillworks.operators.bridges import rewrite_scoped
from tillworks.operators.history import build_history
from tillworks.operators.modes import mode_of
from tillworks.operators.numbering import HEAVY_ROWS, keep_latest
from tillworks.operators.relational import apply_bridge, filter_changed, join_null_safe
from tillworks.plans.tuples import LINES, first_date, last_date, line_count
from tillworks.session import materialize

# A vendor with more tuples is dealt over several tasks before they are unfolded.
MANY_TUPLES = 100_000
# So many unfolded rows a task groups and sorts without spilling.
ROWS_A_SLICE = 1_000_000

PRICE_ATTRIBUTES = [
    "Item Number",
    "Vendor Number",
    "Pack",
    "Bottle Volume ml",
    "State Bottle Cost",
    "State Bottle Retail",
]


def _renumbered(feed: DataFrame, scope: list[str]) -> DataFrame:
    """Old to current item number: same usual description, same vendor.

    Descriptions are weighted by invoice lines, numbers count once per vendor.
    """
    named = feed.select(
        text.clean_item_number("Item Number").alias("Item Number"),
        text.clean_description("Item Description").alias("Item Description"),
        values.fix_vendor("Vendor Number", "Vendor Name").alias("Vendor Number"),
        (F.col(LINES) if LINES in feed.columns else F.lit(1)).alias("lines"),
    )
    usual = mode_of(named, ["Item Number"], "Item Description", "Usual Description", "lines")
    # The vendors of an item as a set: numbers are moved by item alone, which the join needs too.
    sold = named.groupBy("Item Number").agg(F.collect_set("Vendor Number").alias("_vendors"))
    numbers = sold.join(usual, "Item Number").withColumn("Vendor Number", F.explode("_vendors")).drop("_vendors")
    # Read twice, so written once.  A null in number, description or vendor has no group.
    group = ["Usual Description", "Vendor Number"]
    numbers = materialize(numbers.dropna(subset=["Item Number", *group]), "item_numbers")
    # Every number comes once in its group, so the most frequent one, ties to the lowest, is the lowest.
    lowest = numbers.groupBy(*group).agg(F.min("Item Number").alias("Current Item Number"))
    pairs = numbers.join(lowest, group).select(F.col("Item Number").alias("Original Item Number"), *scope, "Current Item Number")
    bridge = filter_changed(pairs, "Original Item Number", "Current Item Number")
    if not scope:
        bridge = bridge.distinct()
    # Different texts may be the same number, such as 007 and 7.
    number = lambda c: F.col(c).try_cast("int").alias(c)
    ids = bridge.select(number("Original Item Number"), *scope, number("Current Item Number"))
    return ids.filter(F.col("Original Item Number") != F.col("Current Item Number"))


def build_item_number_bridge(feed: DataFrame) -> DataFrame:
    """Old to current item number, whatever the vendor: an old number can have several current ones."""
    return _renumbered(feed, [])


def build_item_vendor_bridge(feed: DataFrame) -> DataFrame:
    """Old to current item number within a vendor, the scope the pairs were found in."""
    pairs = _renumbered(feed, ["Vendor Number"]).withColumn(
        "Vendor Number", values.add_prefix("Vendor Number", rules.VENDOR_PREFIX)
    )
    return pairs.distinct()


def rewrite_item(df: DataFrame, item_bridge: DataFrame) -> DataFrame:
    """Current item numbers; within the (prefixed) vendor where the bridge keeps it."""
    names = ("Item Number", "Original Item Number", "Current Item Number")
    if "Vendor Number" in item_bridge.columns:
        return rewrite_scoped(df, item_bridge, *names, {"Vendor Number": "Vendor Number"})
    return apply_bridge(df, item_bridge, *names)


def current_items(item_bridge: DataFrame) -> DataFrame:
    """``_from, _to``: per old number the current ones, as a list."""
    numbered = item_bridge.filter(F.col("Original Item Number").isNotNull())
    lists = numbered.groupBy(F.col("Original Item Number").alias("_from")).agg(
        F.collect_list(F.struct(F.col("Current Item Number").alias("to"))).alias("_to")
    )
    # Numbers are shorter than their text, and sorted ones are packed better.
    return lists.select("_from", F.sort_array(F.transform("_to", lambda t: t["to"])).alias("_to"))


def listed_items() -> Column:
    """The item numbers that ``apply_bridge`` would make a row each of, from ``_to``."""
    every = F.transform("_to", lambda t: F.coalesce(t.cast("string"), F.col("Item Number")))
    return F.coalesce(every, F.array("Item Number"))


def with_current_items(df: DataFrame, item_bridge: DataFrame) -> DataFrame:
    """Add ``_items``, the item numbers that ``apply_bridge`` would make a row each of."""
    lists = current_items(item_bridge)
    listed = df.join(lists, df["Item Number"].try_cast("bigint") == lists["_from"], "left")
    return listed.select(*df.columns, listed_items().alias("_items"))


def _with_rows(df: DataFrame) -> DataFrame:
    """Add ``_rows`` to rows of vendors with more than ``MANY_TUPLES`` of them: their number; null for others."""
    many = df.groupBy("Vendor Number").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > MANY_TUPLES)
    # At most one row for every MANY_TUPLES of the tuples.
    return join_null_safe(df, F.broadcast(many), ["Vendor Number"])


def _slices(df: DataFrame, lists: DataFrame, length: Column) -> int:
    """In how many pieces rows are dealt, so that a task can group and sort what they unfold to in its memory."""
    usual = lists.agg(F.avg(length)).first()[0] or 1
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() * max(usual, 1) / ROWS_A_SLICE))


def _deal(listed: DataFrame, slices: int, singles: Column, first: Column) -> DataFrame:
    """Rows with a list ``_to`` and ``_rows``, dealt by vendor so that what groups by vendor, ``_spread`` and more needs no shuffle.

    Unfolded, a list makes one row into many, which keep their vendor: so rows
    are dealt before.  Vendors of many rows (lines without a vendor number are
    one) are dealt by item too, with lists of one each (``singles``): ``_spread``
    is set for them and depends on the current item number (``first``) alone.
    """
    whole = F.array("_to")
    pieces = F.when(F.col("_rows").isNull() | F.col("_to").isNull(), whole).otherwise(singles)
    single = listed.withColumn("_to", F.explode(pieces))
    spread = F.when(F.col("_rows").isNotNull(), F.coalesce(first, F.col("Item Number"), F.lit("")))
    return single.withColumn("_spread", spread).drop("_rows").repartition(slices, "Vendor Number", "_spread")


def _deal_by_vendor(df: DataFrame, lists: DataFrame) -> DataFrame:
    """``df`` with ``_items``, the numbers that the lists of ``current_items`` make a row each of, and ``_spread``, dealt."""
    marked = _with_rows(df)
    listed = marked.join(lists, marked["Item Number"].try_cast("bigint") == lists["_from"], "left").drop("_from")
    dealt = _deal(listed, _slices(df, lists, F.size("_to")), F.transform("_to", lambda t: F.array(t)), F.get("_to", F.lit(0)).cast("string"))
    return dealt.select(*df.columns, "_spread", listed_items().alias("_items"))


def _unfold(dealt: DataFrame) -> DataFrame:
    rest = [c for c in dealt.columns if c not in ("Item Number", "_items")]
    return dealt.select(*rest, F.explode("_items").alias("Item Number"))


def _rewrite_by_vendor(df: DataFrame, item_bridge: DataFrame) -> DataFrame:
    """``rewrite_item``, with the result dealt so that what groups by vendor, ``_spread`` and more needs no shuffle."""
    if "Vendor Number" in item_bridge.columns:
        # Marked before they move: what reads the many alone moves nothing else.
        moved = rewrite_item(_with_rows(df), item_bridge)
        spread = F.when(F.col("_rows").isNotNull(), F.coalesce("Item Number", F.lit("")))
        slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return moved.select(*df.columns, spread.alias("_spread")).repartition(slices, "Vendor Number", "_spread")
    lists = materialize(current_items(item_bridge), "item_lists")
    return _unfold(_deal_by_vendor(df, lists)).select(*df.columns, "_spread")


def _crowded(df: DataFrame, lists: DataFrame) -> bool:
    """Whether a current item number of a vendor may have more than ``HEAVY_ROWS`` rows: it has those of the numbers that become it."""
    large = df.groupBy("Vendor Number").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > HEAVY_ROWS).drop("_rows")
    if large.isEmpty():
        return False
    counted = join_null_safe(df, F.broadcast(large), ["Vendor Number"], "left_semi").groupBy("Item Number").agg(F.count(F.lit(1)).alias("_rows"))
    listed = counted.join(lists, counted["Item Number"].try_cast("bigint") == lists["_from"], "left")
    numbers = listed.select(F.explode(listed_items()).alias("Item Number"), "_rows").groupBy("Item Number").agg(F.sum("_rows").alias("_rows"))
    return not numbers.filter(F.col("_rows") > HEAVY_ROWS).isEmpty()


def _price_rows(ranges: DataFrame, item_bridge: DataFrame) -> tuple[DataFrame, Column]:
    """Price tuples of current items, dealt, and which of their rows can belong to a heavy key."""
    merge = lambda df: df.groupBy(*PRICE_ATTRIBUTES, "_spread").agg(
        F.min("From Date").alias("From Date"), F.max("To Date").alias("To Date")
    )
    if "Vendor Number" in item_bridge.columns:
        # A key of an ordinary vendor has at most as many rows as the vendor.
        return merge(_rewrite_by_vendor(ranges, item_bridge)), F.col("_spread").isNotNull()
    lists = materialize(current_items(item_bridge), "item_lists")
    dealt = _deal_by_vendor(ranges, lists).withColumn("_items", F.array_distinct("_items"))
    # Only rows that share all but the item can merge when they are unfolded, and few do.
    alike = dealt.withColumn("_alike", F.count(F.lit(1)).over(Window.partitionBy(*PRICE_ATTRIBUTES[1:], "_spread")))
    alone, several = (_unfold(alike.filter(c).drop("_alike")) for c in ("_alike = 1", "_alike > 1"))
    merged = merge(several)
    heavy = F.col("_spread").isNotNull() if _crowded(ranges, lists) else F.lit(False)
    return alone.select(merged.columns).union(merged), heavy


def _place() -> Column:
    """A number that follows from item and vendor: as the first key of a sort it settles most comparisons, by item where items are numbers."""
    item = F.coalesce(F.shiftleft(F.col("Item Number").try_cast("int").cast("bigint"), 32), F.xxhash64("Item Number"))
    return item + F.hash("Vendor Number").bitwiseAND(F.lit((1 << 31) - 1))


def build_item_price_history(feed: DataFrame, item_bridge: DataFrame) -> DataFrame:
    """First and last day of every price tuple of an (item, vendor)."""
    ranges = feed.select(
        text.clean_item_number("Item Number").alias("Item Number"),
        values.add_prefix(
            values.fix_vendor("Vendor Number", "Vendor Name"), rules.VENDOR_PREFIX
        ).alias("Vendor Number"),
        "Pack",
        F.col("Bottle Volume (ml)").alias("Bottle Volume ml"),
        "State Bottle Cost",
        "State Bottle Retail",
        first_date(feed).alias("From Date"),
        last_date(feed).alias("To Date"),
    )
    rows, heavy = _price_rows(ranges, item_bridge)
    keys = ["_place", "Item Number", "Vendor Number", "_spread"]
    history = build_history(rows.withColumn("_place", _place()), keys, "Price Sequence", heavy)
    prefixed = history.withColumn("Item Number", values.add_prefix("Item Number", rules.ITEM_PREFIX))
    columns = PRICE_ATTRIBUTES + ["From Date", "To Date", "Is Current", "Price Sequence"]
    return prefixed.select(columns)


def build_item(feed: DataFrame, category: DataFrame, item_bridge: DataFrame) -> DataFrame:
    """The latest row of every (item, vendor, category).

    Description and category follow from the current item number, so they are
    voted on by item, and rows meet them after the latest one is found.
    """
    lines = feed.select(
        text.clean_item_number("Item Number").alias("Item Number"),
        text.clean_description("Item Description").alias("Item Description"),
        text.clean_category("Category Name").alias("Category Name"),
        values.add_prefix(
            values.fix_vendor("Vendor Number", "Vendor Name"), rules.VENDOR_PREFIX
        ).alias("Vendor Number"),
        "Pack",
        F.col("Bottle Volume (ml)").alias("Bottle Volume ml"),
        F.col("State Bottle Cost").alias("State Bottle cost"),
        "State Bottle Retail",
        last_date(feed).alias("Date"),
        (F.col(LINES) if LINES in feed.columns else F.lit(1)).alias("_lines"),
    )
    scope = [c for c in ["Vendor Number"] if c in item_bridge.columns]
    called = lines.groupBy("Item Number", *scope, "Item Description", "Category Name").agg(F.sum("_lines").alias("lines"))
    votes = rewrite_item(called, item_bridge).groupBy("Item Number", "Item Description", "Category Name").agg(F.sum("lines").alias("lines"))
    votes = materialize(votes, "item_votes")
    usual = mode_of(votes, ["Item Number"], "Item Description", "Item Description", "lines")
    described = join_null_safe(votes.drop("Item Description"), usual, ["Item Number"])
    described = described.groupBy("Item Description", "Category Name").agg(F.sum("lines").alias("lines"))
    labels = mode_of(described.filter(F.col("Item Description").isNotNull()), ["Item Description"], "Category Name", "Category Name", "lines")
    labels = labels.withColumn(
        "Category Name", values.correct_values("Category Name", rules.CATEGORY_NAME)
    )
    known = usual.join(labels, "Item Description", "left").join(category, "Category Name", "left").drop("Category Name")
    # Null keys are kept by a grouping and lost by a join, as a mode is null for them.
    known = known.filter(F.col("Item Number").isNotNull())

    measures = ["Pack", "Bottle Volume ml", "State Bottle cost", "State Bottle Retail"]
    rows = lines.select("Item Number", "Vendor Number", "Date", *measures)
    if scope:
        bridged = _rewrite_by_vendor(rows, item_bridge)
        latest = keep_latest(bridged, ["Item Number", "Vendor Number", "_spread"], "Date").join(known, "Item Number", "left")
    else:
        names = [c for c in known.columns if c != "Item Number"]
        bridged = _deal_described(rows, item_bridge, known)
        # What is known of an item follows from it.
        latest = keep_latest(bridged.withColumn("_place", _place()), ["_place", "Item Number", "Vendor Number", "_spread", *names], "Date")
    return latest.select(
        values.add_prefix("Item Number", rules.ITEM_PREFIX).alias("Item Number"),
        "Item Description",
        "Category Number",
        "Vendor Number",
        *measures,
    )


def _deal_described(df: DataFrame, item_bridge: DataFrame, known: DataFrame) -> DataFrame:
    """``rewrite_item`` joined with ``known`` by item, dealt as by ``_rewrite_by_vendor``: lists carry what is known of their items.

    Current numbers of an item are mostly called alike, so a list says it once.
    """
    names = [c for c in known.columns if c != "Item Number"]
    numbers = df.select("Item Number").distinct().filter(F.col("Item Number").isNotNull())
    current = rewrite_item(numbers.withColumn("_old", F.col("Item Number")), item_bridge).join(known, "Item Number", "left")
    # Numbers are shorter than their text; none stands for the item itself, which may be no number.
    kind = item_bridge.schema["Current Item Number"].dataType
    number = F.when(F.col("Item Number") != F.col("_old"), F.col("Item Number").try_cast(kind))
    alike = current.groupBy("_old", *names).agg(F.collect_list(F.struct(number.alias("to"))).alias("_numbers"))
    alike = alike.withColumn("_numbers", F.sort_array(F.transform("_numbers", lambda t: t["to"])))
    text_of = lambda n: F.coalesce(n.cast("string"), F.col("Item Number"))
    lists = alike.groupBy("_old").agg(F.collect_list(F.struct(*names, "_numbers")).alias("_to"))
    lists = materialize(lists, "item_lists")
    marked = _with_rows(df)
    listed = marked.join(lists, marked["Item Number"] == lists["_old"], "left").drop("_old")
    length = F.aggregate("_to", F.lit(0), lambda n, g: n + F.size(g["_numbers"]))
    # Of a vendor of many rows, those called alike stay together, cut by number so that a task has few times MANY_TUPLES of them.
    cuts = F.ceil(F.col("_rows") / (10 * MANY_TUPLES)).cast("int")
    cut = lambda g, k: F.struct(
        *[g[c].alias(c) for c in names], F.filter(g["_numbers"], lambda n: F.pmod(F.hash(text_of(n)), cuts) == k).alias("_numbers")
    )
    cut_up = F.flatten(F.transform("_to", lambda g: F.transform(F.sequence(F.lit(0), cuts - 1), lambda k: F.array(cut(g, k)))))
    singles = F.filter(cut_up, lambda p: F.size(F.get(p, F.lit(0))["_numbers"]) > 0)
    start = F.get("_to", F.lit(0))
    first = F.concat_ws("-", F.hash(*[start[c] for c in names]), F.pmod(F.hash(text_of(F.get(start["_numbers"], F.lit(0)))), cuts))
    # Of a row without a list the item number tells it from others, as nothing becomes that number.
    first = F.when(F.col("_to").isNotNull(), first)
    dealt = _deal(listed, _slices(df, lists, length), singles, first)
    group = dealt.withColumn("_group", F.explode_outer("_to"))
    called = group.select(*df.columns, "_spread", *[F.col("_group")[c].alias(c) for c in names], F.coalesce(F.transform("_group._numbers", text_of), F.array("Item Number")).alias("_items"))
    return _unfold(called)
