"""The dimension refresh: every table in dependency order, each written once."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillworks.operators.relational import sort_output
from tillworks.plans import dimensions, items, stores
from tillworks.plans.tuples import FAMILIES, write_tuples
from tillworks.session import new_folder
from tillworks.sources.files import write_table


@dataclass(frozen=True)
class Job:
    """A table: the tuples of the feed it starts from, the tables it reads besides, how it is built, which columns of the feed that takes, the order it is delivered in, and whether it reads the first and last dates of tuples.

    Item rows and prices come in none: there are many times more of them than of
    the tuples, and they are built without being moved.
    """

    family: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]
    columns: tuple[str, ...]
    order: tuple[str, ...] = ()
    ranged: bool = False

    def ordered(self, table: DataFrame) -> DataFrame:
        return sort_output(table, *self.order) if self.order else table


_VENDOR = ("Vendor Number", "Vendor Name")
_ITEM = ("Item Number", "Item Description", *_VENDOR)
_PRICE = ("Item Number", *_VENDOR, "Pack", "Bottle Volume (ml)", "State Bottle Cost", "State Bottle Retail")
_STORE = ("Store Number", "Store Name", "Address")
_PLACE = (*stores.ADDRESS_KEYS, "Store Location")


JOBS: dict[str, Job] = {
    "item_number_bridge": Job("items", (), items.build_item_number_bridge, _ITEM, ("Current Item Number", "Original Item Number")),
    "item_vendor_bridge": Job("items", (), items.build_item_vendor_bridge, _ITEM, ("Current Item Number", "Original Item Number")),
    "category": Job("items", (), dimensions.build_category, ("Category Name",)),
    "vendor": Job("items", (), dimensions.build_vendor, _VENDOR),
    "store_county": Job("stores", (), dimensions.build_store_county, ("County Number", "County"), ("County Name",)),
    "store_address_bridge": Job("stores", (), stores.build_store_address_bridge, ("Address",), ("Original Address",)),
    "item_price_history": Job("items", ("item_number_bridge",), items.build_item_price_history, _PRICE, ranged=True),
    "item_vendor_price_history": Job("items", ("item_vendor_bridge",), items.build_item_price_history, _PRICE, ranged=True),
    "item": Job("items", ("category", "item_number_bridge"), items.build_item, tuple(FAMILIES["items"]), ranged=True),
    "store_number_bridge": Job("stores", ("store_address_bridge",), stores.build_store_number_bridge, _STORE, ("Current Store Number", "Original Store Number")),
    "store_site_bridge": Job("stores", ("store_address_bridge",), stores.build_store_site_bridge, _STORE, ("Current Store Number", "Original Store Number")),
    "store_address_history": Job(
        "stores", ("store_number_bridge", "store_address_bridge"), stores.build_store_address_history, _PLACE, ("Store Number", "To Date"), True
    ),
    "store_site_history": Job(
        "stores", ("store_site_bridge", "store_address_bridge"), stores.build_store_address_history, _PLACE, ("Store Number", "To Date"), True
    ),
    "store_address": Job(
        "stores", ("store_number_bridge", "store_address_bridge"), stores.build_store_address, (*_PLACE, "Store Name", "Date"), ("Store Number",)
    ),
}

FACT_INPUTS = (
    "item_number_bridge",
    "item_price_history",
    "store_number_bridge",
    "store_address_bridge",
    "store_address_history",
)

# The same, with bridges and histories that keep their scope.
ASOF_INPUTS = (
    "item_vendor_bridge",
    "item_vendor_price_history",
    "store_site_bridge",
    "store_address_bridge",
    "store_site_history",
)


def order_of(tables: Iterable[str]) -> list[str]:
    """``tables`` and all they need, inputs first."""
    done: list[str] = []

    def visit(table: str) -> None:
        if table not in done:
            for need in JOBS[table].needs:
                visit(need)
            done.append(table)

    for table in tables:
        visit(table)
    return done


def families_of(tables: Iterable[str]) -> dict[str, list[str]]:
    """The families and columns of tuples that ``tables`` and all they need are built from."""
    wanted: dict[str, set[str]] = {}
    for table in order_of(tables):
        wanted.setdefault(JOBS[table].family, set()).update(JOBS[table].columns)
    return {name: [c for c in family if c in wanted[name]] for name, family in FAMILIES.items() if name in wanted}


def ranged_families(tables: Iterable[str]) -> set[str]:
    """The families of which ``tables``, or what they need, read first and last dates."""
    return {JOBS[table].family for table in order_of(tables) if JOBS[table].ranged}


def refresh(feed: DataFrame, root: str, tables: Iterable[str] = tuple(JOBS)) -> dict[str, DataFrame]:
    """Build ``tables`` from one scan of the feed, write them under ``root`` and read them back.

    A job that fails raises; nothing after it runs on half-made inputs.
    """
    tables = order_of(tables)
    tuples = write_tuples(feed, new_folder(feed.sparkSession, "tuples"), families_of(tables))
    built: dict[str, DataFrame] = {}
    for table in tables:
        job = JOBS[table]
        result = job.ordered(job.build(tuples[job.family], *[built[n] for n in job.needs]))
        path = f"{root}/{table}"
        write_table(result, path)
        built[table] = feed.sparkSession.read.schema(result.schema).parquet(path)
    return built
