"""Declared schemas of the feed and of every table, as DDL strings."""

from pyspark.sql.types import StructType

# Column names, order and types as published.
_DDL = {
    "sales_feed": """
        `Invoice/Item Number` string, `Date` string, `Store Number` int, `Store Name` string,
        `Address` string, `City` string, `Zip Code` string, `Store Location` string,
        `County Number` int, `County` string, `Category` int, `Category Name` string,
        `Vendor Number` int, `Vendor Name` string, `Item Number` string,
        `Item Description` string, `Pack` int, `Bottle Volume (ml)` int,
        `State Bottle Cost` double, `State Bottle Retail` double, `Bottles Sold` int,
        `Sale (Dollars)` double, `Volume Sold (Liters)` double, `Volume Sold (Gallons)` double""",
    "item_number_bridge": "`Original Item Number` int, `Current Item Number` int",
    "category": "`Category Number` string, `Category Name` string",
    "vendor": "`Vendor Number` string, `Vendor Name` string",
    "item_price_history": """
        `Item Number` string, `Vendor Number` string, `Pack` int, `Bottle Volume ml` int,
        `State Bottle Cost` double, `State Bottle Retail` double, `From Date` date,
        `To Date` date, `Is Current` boolean, `Price Sequence` int""",
    "item": """
        `Item Number` string, `Item Description` string, `Category Number` string,
        `Vendor Number` string, `Pack` int, `Bottle Volume ml` int,
        `State Bottle cost` double, `State Bottle Retail` double""",
    "store_number_bridge": "`Original Store Number` int, `Current Store Number` int",
    "store_address_bridge": "`Original Address` string, `Current Address` string",
    "store_county": "`County Number` string, `County Name` string",
    "store_address_history": """
        `Store Number` string, `Address` string, `City` string, `Zip Code` int,
        `County Number` string, `Latitude` double, `Longitude` double, `From Date` date,
        `To Date` date, `Is Current` boolean, `Address Sequence` int""",
    "store_address": """
        `Store Number` string, `Store Name` string, `Address` string, `City` string,
        `Zip Code` int, `County Number` string, `Latitude` double, `Longitude` double""",
    "invoice": """
        `Invoice_Item Number` string, `Store Number` string, `Address Sequence` int,
        `Item Number` string, `Vendor Number` string, `Price Sequence` int, `Items Sold` int,
        `Sale Dollars` double, `Sale Baht` double, `Volume Sold Liters` double, `Date` date""",
}

TABLES = tuple(name for name in _DDL if name != "sales_feed")


def schema_of(name: str) -> StructType:
    """The declared schema of ``name``; unknown names raise ``KeyError``."""
    return StructType.fromDDL(_DDL[name])


def columns_of(name: str) -> list[str]:
    return schema_of(name).names
