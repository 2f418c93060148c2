"""The invoice fact table, one row per invoice line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks import rules
from tillworks.functions import text, values
from tillworks.functions.typed import derive_measures, feed_date
from tillworks.operators.intervals import asof_join
from tillworks.operators.relational import join_null_safe
from tillworks.plans.items import PRICE_ATTRIBUTES, rewrite_item, with_current_items
from tillworks.plans.stores import rewrite_address, rewrite_store
from tillworks.sources.months import MONTH

FACT_COLUMNS = [
    "Invoice_Item Number",
    "Store Number",
    "Address Sequence",
    "Item Number",
    "Vendor Number",
    "Price Sequence",
    "Items Sold",
    "Sale Dollars",
    "Sale Baht",
    "Volume Sold Liters",
    "Date",
]


def _months(df: DataFrame) -> list[str]:
    return [c for c in MONTH if c in df.columns]


def _lines(
    feed: DataFrame,
    item_bridge: DataFrame,
    price_history: DataFrame,
    kept: list[str],
) -> DataFrame:
    """Feed lines with conformed items and vendors, price sequence and measures; ``kept`` columns stay as they are."""
    lines = feed.select(
        F.col("Invoice/Item Number").alias("Invoice_Item Number"),
        *kept,
        text.clean_item_number("Item Number").alias("Item Number"),
        values.add_prefix(
            values.fix_vendor("Vendor Number", "Vendor Name"), rules.VENDOR_PREFIX
        ).alias("Vendor Number"),
        "Pack",
        F.col("Bottle Volume (ml)").alias("Bottle Volume ml"),
        "State Bottle Cost",
        "State Bottle Retail",
        F.col("Bottles Sold").alias("Items Sold"),
        *_months(feed),
    )
    # Cost and retail are doubles from the same source value on both sides.
    prices = price_history.select(*PRICE_ATTRIBUTES, "Price Sequence")
    if "Vendor Number" in item_bridge.columns:
        lines = rewrite_item(lines, item_bridge).withColumn(
            "Item Number", values.add_prefix("Item Number", rules.ITEM_PREFIX)
        )
        lines = lines.join(prices, PRICE_ATTRIBUTES, "left")
    else:
        lines = _with_prices(with_current_items(lines, item_bridge), prices)
    return derive_measures(lines)


def _placed(df: DataFrame, number_bridge: DataFrame, address_bridge: DataFrame, how: str) -> DataFrame:
    """Conformed store numbers and addresses."""
    renumbered = rewrite_store(df, number_bridge, address_bridge).withColumn(
        "Store Number", values.add_prefix("Store Number", rules.STORE_PREFIX)
    )
    return rewrite_address(renumbered, address_bridge, how)


def _stays(
    places: DataFrame, number_bridge: DataFrame, address_bridge: DataFrame, address_history: DataFrame, how: str
) -> DataFrame:
    """For every store, address and day as they are in the feed: ``_store``, the current number, and the address sequence of that day."""
    raw = ["Store Number", "Address"]
    days = places.select(*raw, feed_date(places).alias("Date")).distinct()
    placed = _placed(days.withColumns({f"_raw {c}": F.col(c) for c in raw}), number_bridge, address_bridge, how)
    valid = asof_join(placed, address_history, raw, "Date", "From Date", "To Date", "Address Sequence")
    return valid.select(
        *[F.col(f"_raw {c}").alias(c) for c in raw], "Date", F.col("Store Number").alias("_store"), "Address Sequence"
    ).distinct()


def _with_prices(lines: DataFrame, prices: DataFrame) -> DataFrame:
    """Lines with ``_items`` and, in ``_prices``, the sequences that items have at the vendor and price of the line.

    A bridge without its scope gives a line many items.  They share all else, so
    lines stay whole here and are unfolded by ``_distinct_rows`` when they move no more.
    """
    shared = PRICE_ATTRIBUTES[1:]
    listed = prices.dropna(subset=PRICE_ATTRIBUTES).groupBy(*shared).agg(
        F.collect_list(F.struct("Item Number", "Price Sequence")).alias("_prices")
    )
    prefixed = F.transform("_items", lambda i: values.add_prefix(i, rules.ITEM_PREFIX))
    return lines.withColumn("_items", prefixed).drop("Item Number").join(listed, shared, "left")


def _distinct_rows(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct ``columns``, with a row per item of a line and sequence of that item, which is null where it has none.

    Lines alike in all else are put together before they are unfolded, so that
    the many rows a line unfolds to are compared with those of like lines alone.
    """
    if "_items" not in lines.columns:
        return lines.select(*columns).distinct()
    item, sequence = "Item Number", "Price Sequence"
    kind = lines.schema["_prices"].dataType.elementType[sequence].dataType
    bare = lambda i: F.struct(i.alias(item), F.lit(None).cast(kind).alias(sequence))
    fitting = F.filter("_prices", lambda p: F.array_contains("_items", p[item]))
    others = F.transform(F.array_except("_items", F.transform("_prices", lambda p: p[item])), bare)
    pairs = F.when(F.col("_prices").isNull(), F.transform("_items", bare)).otherwise(F.concat(fitting, others))
    own = [c for c in columns if c not in (item, sequence)]
    alike = lines.select(*own, pairs.alias("_pairs")).groupBy(*own).agg(F.array_distinct(F.flatten(F.collect_set("_pairs"))).alias("_pairs"))
    single = alike.select(*own, F.explode("_pairs").alias("_pair"))
    return single.select(*[F.col("_pair")[c].alias(c) if c in (item, sequence) else F.col(c) for c in columns])


def _invoice_dates(feed: DataFrame) -> DataFrame:
    """The distinct dates of each invoice line number, at most a calendar's worth."""
    return feed.groupBy(
        F.col("Invoice/Item Number").alias("Invoice_Item Number"), *_months(feed)
    ).agg(F.collect_set(F.struct(feed_date(feed).alias("d"))).alias("_dates"))


def _attach_dates(lines: DataFrame, feed: DataFrame) -> DataFrame:
    # The join leaves rows partitioned by invoice number (and month), which also
    # serves the final distinct: rows are shuffled once for both.
    dated = lines.join(_invoice_dates(feed), ["Invoice_Item Number", *_months(feed)], "left")
    return dated.withColumn("_date", F.explode_outer("_dates")).withColumn("Date", F.col("_date.d"))


def build_fact(
    feed: DataFrame,
    item_bridge: DataFrame,
    price_history: DataFrame,
    number_bridge: DataFrame,
    address_bridge: DataFrame,
    address_history: DataFrame,
    how: str = "inner",
) -> DataFrame:
    """Distinct fact lines; a store with several history rows at an address fans out.

    ``feed`` is one month or many.  When it carries ``Year`` and ``Month`` they
    are kept as the last columns and dates are looked up within the month.
    Lines with a null or unknown address are dropped unless ``how="left"``.
    """
    lines = _placed(_lines(feed, item_bridge, price_history, ["Store Number", "Address"]), number_bridge, address_bridge, how)
    sequences = address_history.select("Store Number", "Address", "Address Sequence")
    placed = lines.join(sequences, ["Store Number", "Address"], "left")
    return _distinct_rows(_attach_dates(placed, feed), [*FACT_COLUMNS, *_months(feed)])


def build_fact_asof(
    feed: DataFrame,
    item_bridge: DataFrame,
    price_history: DataFrame,
    number_bridge: DataFrame,
    address_bridge: DataFrame,
    address_history: DataFrame,
    how: str = "inner",
    places: DataFrame | None = None,
) -> DataFrame:
    """The fact with the history row valid on the day of the line: one row per distinct line.

    Items are renumbered within their vendor and stores within their site (the
    scoped bridges), so no join adds rows; bridges without a scope are taken too
    and fan out as in ``build_fact``.  Where validity ranges overlap the latest
    sequence wins; a line without a date or outside all ranges has none.

    Stores are looked up per distinct store, address and day, so lines are moved
    once for all of it.  ``places`` has those of the feed, where they are to be
    had without its lines.
    """
    stays = _stays(feed if places is None else places, number_bridge, address_bridge, address_history, how)
    # An address that the inner form drops has no row here; all others have at least one.
    # The address goes no further with the lines.
    found = join_null_safe(feed.withColumn("Date", feed_date(feed)), stays, ["Store Number", "Address", "Date"], "inner")
    placed = found.withColumn("Store Number", F.col("_store"))
    lines = _lines(placed, item_bridge, price_history, ["Store Number", "Address Sequence", "Date"])
    return _distinct_rows(lines, [*FACT_COLUMNS, *_months(feed)])


def line_report(feed: DataFrame, fact: DataFrame) -> DataFrame:
    """Lines per month in the feed and in the fact: what was dropped or fanned out."""
    before = feed.groupBy(*MONTH).agg(F.count(F.lit(1)).alias("feed_lines"))
    after = fact.groupBy(*MONTH).agg(F.count(F.lit(1)).alias("fact_lines"))
    return before.join(after, MONTH, "full").na.fill(0, ["feed_lines", "fact_lines"])
