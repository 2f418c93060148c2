"""Store tables: address bridge, number bridge, address history, address dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks import rules
from tillworks.functions import text, values
from tillworks.functions.typed import cast_typed, feed_date, split_point
from tillworks.operators.bridges import rewrite_scoped, single_valued
from tillworks.operators.history import build_history
from tillworks.operators.modes import build_bridge, canonical_by_mode, mode_of, modes_of
from tillworks.operators.numbering import keep_latest
from tillworks.operators.relational import (
    apply_bridge,
    drop_null_all,
    drop_null_duplicates,
)
from tillworks.plans.tuples import first_date, last_date

ADDRESS_KEYS = ["Store Number", "Address", "City", "Zip Code", "County Number"]


def build_store_address_bridge(feed: DataFrame) -> DataFrame:
    """Every upper-cased raw address and its standard form."""
    # The count keeps this grouping apart from the last one, so that the patterns run once per raw address.
    raw = feed.groupBy("Address").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 0)
    pairs = raw.select(
        text.upper_text("Address").alias("Original Address"),
        text.standardize_address("Address").alias("Current Address"),
    )
    return pairs.distinct()


def rewrite_address(df: DataFrame, address_bridge: DataFrame, how: str = "inner") -> DataFrame:
    """Upper-case the address and replace it by its standard form.

    The inner form drops rows with a null or unknown address.
    """
    raised = df.withColumn("Address", text.upper_text("Address"))
    return apply_bridge(raised, address_bridge, "Address", "Original Address", "Current Address", how)


def _with_site(df: DataFrame, address_bridge: DataFrame) -> DataFrame:
    """Add the standard address as ``Site``.

    An address missing from the bridge is null here, unlike in a rewrite that
    keeps the old value: such stores have no site to share.  The bridge is held
    to one standard form per address, so no row comes twice.
    """
    sites = single_valued(address_bridge, ["Original Address"], "Current Address").toDF("_raw", "Site")
    return df.join(sites, text.upper_text(df["Address"]) == sites["_raw"], "left").drop("_raw")


def rewrite_store(df: DataFrame, number_bridge: DataFrame, address_bridge: DataFrame | None = None) -> DataFrame:
    """Current store numbers; within the site where the bridge keeps it."""
    names = ("Store Number", "Original Store Number", "Current Store Number")
    if "Site" in number_bridge.columns:
        return rewrite_scoped(_with_site(df, address_bridge), number_bridge, *names, {"Site": "Site"}).select(df.columns)
    return apply_bridge(df, number_bridge, *names)


def _renumbered(feed: DataFrame, address_bridge: DataFrame, scope: list[str]) -> DataFrame:
    """Old to current store number: same usual name, same standard address.

    Names count once per distinct raw (number, name, address); numbers once per
    distinct raw address.
    """
    triples = feed.select("Store Number", "Store Name", "Address").distinct()
    named = triples.withColumn("Store Name", text.clean_text("Store Name", "initcap"))
    usual = mode_of(named, ["Store Number"], "Store Name", "Usual Name")
    sites = (
        triples.select("Store Number", "Address")
        .distinct()
        .join(usual, "Store Number", "left")
    )
    return build_bridge(
        _with_site(sites, address_bridge).drop("Address"),
        "Store Number",
        ["Usual Name", "Site"],
        "Original Store Number",
        "Current Store Number",
        scope=scope,
    )


def build_store_number_bridge(feed: DataFrame, address_bridge: DataFrame) -> DataFrame:
    """Old to current store number, whatever the site: an old number can have several current ones."""
    return _renumbered(feed, address_bridge, [])


def build_store_site_bridge(feed: DataFrame, address_bridge: DataFrame) -> DataFrame:
    """Old to current store number at a site, the scope the pairs were found in."""
    return _renumbered(feed, address_bridge, ["Site"])


def _place_corrections(df: DataFrame) -> DataFrame:
    """Keyed overrides of county, zip and city, then the city dictionary."""
    city = values.override_by_key("City", "Store Number", rules.STORE_CITY)
    return df.withColumns(
        {
            "County Number": values.override_by_key(
                "County Number", "Store Number", rules.STORE_COUNTY_NUMBER
            ),
            "Zip Code": values.override_by_key("Zip Code", "Store Number", rules.STORE_ZIP),
            "City": values.correct_values(city, rules.CITY),
        }
    )


def _zip_number(c: str):
    return cast_typed(values.correct_values(c, rules.ZIP_FORMAT), "int")


def with_coordinates(df: DataFrame) -> DataFrame:
    """``Store Location`` as ``Longitude`` and ``Latitude``."""
    return df.withColumns(
        {
            "Longitude": split_point("Store Location", 1),
            "Latitude": split_point("Store Location", 2),
        }
    ).drop("Store Location")


def build_store_address_history(
    feed: DataFrame, number_bridge: DataFrame, address_bridge: DataFrame, how: str = "inner"
) -> DataFrame:
    """First and last day of every place a store has been at."""
    raw = drop_null_all(
        feed.select(*ADDRESS_KEYS, "Store Location", first_date(feed).alias("_first"), last_date(feed).alias("_last")),
        ["Address", "City", "Zip Code", "County Number"],
    )
    # Ranges of raw rows first: later steps only merge ranges.
    located = [*ADDRESS_KEYS, "Store Location"]
    ranges = raw.groupBy(*located).agg(F.min("_first").alias("From"), F.max("_last").alias("To"))
    cleaned = ranges.withColumns(
        {
            "City": text.clean_text("City", "upper"),
            "Address": text.upper_text("Address"),
            "Zip Code": _zip_number("Zip Code"),
        }
    )
    bridged = rewrite_store(cleaned, number_bridge, address_bridge)
    kept = drop_null_duplicates(
        bridged, "County Number", ["Store Number", "Address", "City", "Zip Code"]
    )
    merged = kept.groupBy(*located).agg(F.min("From").alias("From"), F.max("To").alias("To"))
    placed = rewrite_address(_place_corrections(merged), address_bridge, how)
    places = modes_of(
        with_coordinates(placed),
        ADDRESS_KEYS,
        {"Latitude": "Latitude", "Longitude": "Longitude"},
        lows={"From Date": "From"},
        highs={"To Date": "To"},
    )
    history = build_history(places, ["Store Number"], "Address Sequence")
    return history.select(
        values.add_prefix("Store Number", rules.STORE_PREFIX).alias("Store Number"),
        "Address",
        "City",
        "Zip Code",
        values.add_prefix("County Number", rules.COUNTY_PREFIX).alias("County Number"),
        "Latitude",
        "Longitude",
        "From Date",
        "To Date",
        "Is Current",
        "Address Sequence",
    )


def build_store_address(
    feed: DataFrame, number_bridge: DataFrame, address_bridge: DataFrame, how: str = "inner"
) -> DataFrame:
    """The latest place and usual name of every store."""
    described = ["Store Number", "Store Name", *ADDRESS_KEYS[1:], "Store Location"]
    # A raw tuple counts once per day it was seen on.
    days = feed.select(*described, feed_date(feed).alias("Date")).distinct()
    tuples = days.groupBy(*described).agg(
        F.count(F.lit(1)).alias("days"), F.max("Date").alias("Date")
    )
    cleaned = tuples.withColumns(
        {
            "Store Name": text.clean_text("Store Name", "initcap"),
            "City": text.clean_text("City", "upper"),
            "Zip Code": _zip_number("Zip Code"),
        }
    )
    bridged = rewrite_store(cleaned, number_bridge, address_bridge)
    kept = drop_null_duplicates(bridged, "County Number", ["Store Number"])
    placed = rewrite_address(_place_corrections(kept), address_bridge, how)
    named = canonical_by_mode(placed, ["Store Number"], "Store Name", "days")
    places = modes_of(
        with_coordinates(named),
        ["Store Number", "Store Name", *ADDRESS_KEYS[1:]],
        {"Latitude": "Latitude", "Longitude": "Longitude"},
        weight="days",
        highs={"Date": "Date"},
    )
    latest = keep_latest(places, ["Store Number"], "Date")
    return latest.select(
        values.add_prefix("Store Number", rules.STORE_PREFIX).alias("Store Number"),
        "Store Name",
        "Address",
        "City",
        "Zip Code",
        values.add_prefix("County Number", rules.COUNTY_PREFIX).alias("County Number"),
        "Latitude",
        "Longitude",
    )
