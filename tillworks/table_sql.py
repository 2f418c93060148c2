"""SQL for the table jobs over the feed: pieces that a checking engine runs as common table expressions.

``sales`` is the feed.  Every job is said row by row here, without the tuples and
partial results the Spark jobs go through.
"""

from __future__ import annotations

from tillworks import rules
from tillworks.adapter import sales_sql

INITCAP = "array_to_string(list_transform(string_split(lower({0}), ' '), lambda w: concat(upper(w[1]), w[2:])), ' ')"
CLEAN = "trim(replace(replace(translate({0}, '\"''.,', ''), '  ', ' '), '&', 'and'))"


def address_sql(c: str) -> str:
    out = f"upper({CLEAN.format(c)})"
    for pattern, replacement in rules.ADDRESS_PATTERNS:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    out = f"trim(replace({out}, '  ', ' '))"
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return f"CASE {out} " + " ".join(f"WHEN {quote(a)} THEN {quote(b)}" for a, b in rules.ADDRESS.items()) + f" ELSE {out} END"


def case_sql(c: str, mapping: dict, key: str | None = None) -> str:
    show = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"CASE {key or c} " + " ".join(f"WHEN {show(a)} THEN {show(b)}" for a, b in mapping.items()) + f" ELSE {c} END"


def mode_sql(keys: str, column: str, source: str, alias: str) -> str:
    return f"""(SELECT {keys}, max(CASE WHEN rn = 1 THEN v END) AS {alias} FROM (SELECT {keys}, {column} AS v,
      CASE WHEN {column} IS NOT NULL THEN row_number() OVER (PARTITION BY {keys} ORDER BY {column} IS NULL, count(*) DESC, {column}) END AS rn
      FROM {source} GROUP BY {keys}, {column}) GROUP BY {keys})"""


def with_sales(ctes: str, select: str) -> str:
    return f"WITH sales AS ({sales_sql()}), {ctes} {select}"


VENDOR = 'CASE WHEN upper("Vendor Name") = \'RESERVOIR DISTILLERY\' THEN 988 ELSE "Vendor Number" END'
LABEL = INITCAP.format("translate(" + '"Item Description"' + ", '.\"''�°', '')")
TUPLES = f"""tuples AS (SELECT translate("Item Number", 'x', '') AS item, {LABEL} AS label, CAST({VENDOR} AS VARCHAR) AS vendor FROM sales)"""
# Renumbered items within their vendor, and without it.
ITEM_PAIRS = f"""numbers AS (SELECT DISTINCT t.item, t.vendor, u.label FROM tuples t LEFT JOIN {mode_sql("item", "label", "tuples", "label")} u USING (item)),
  item_pairs AS (SELECT DISTINCT TRY_CAST(n.item AS INT) AS original_item_number, 'VEN_' || n.vendor AS vendor_number, TRY_CAST(m.cur AS INT) AS current_item_number
  FROM numbers n JOIN {mode_sql("label, vendor", "item", "(SELECT * FROM numbers WHERE label IS NOT NULL AND vendor IS NOT NULL)", "cur")} m
  ON n.label = m.label AND n.vendor = m.vendor WHERE TRY_CAST(n.item AS INT) <> TRY_CAST(m.cur AS INT))"""
ITEM_BRIDGE = f"{ITEM_PAIRS}, item_bridge AS (SELECT DISTINCT original_item_number, current_item_number FROM item_pairs)"
# One current number per item and vendor, for the guarded join.
ITEM_ONES = f"""{ITEM_PAIRS}, item_bridge AS (SELECT original_item_number, vendor_number, min(current_item_number) AS current_item_number
  FROM item_pairs GROUP BY 1, 2)"""

ADDRESSES = f"""addresses AS (SELECT DISTINCT upper("Address") AS raw, {address_sql('"Address"')} AS site FROM sales WHERE "Address" IS NOT NULL)"""
STORE_PAIRS = f"""{ADDRESSES}, triples AS (SELECT DISTINCT "Store Number" AS store, "Store Name" AS name, "Address" AS address FROM sales),
  called AS (SELECT store, {INITCAP.format(CLEAN.format("name"))} AS name FROM triples),
  placed AS (SELECT p.store, u.name, a.site FROM (SELECT DISTINCT store, address FROM triples) p
    LEFT JOIN {mode_sql("store", "name", "called", "name")} u USING (store) LEFT JOIN addresses a ON upper(p.address) = a.raw),
  store_pairs AS (SELECT DISTINCT p.store AS original_store_number, p.site, m.cur AS current_store_number FROM placed p
    JOIN {mode_sql("name, site", "store", "(SELECT * FROM placed WHERE name IS NOT NULL AND site IS NOT NULL)", "cur")} m
    ON p.name = m.name AND p.site = m.site WHERE p.store <> m.cur)"""
STORE_BRIDGE = f"{STORE_PAIRS}, store_bridge AS (SELECT DISTINCT original_store_number, current_store_number FROM store_pairs)"


def _store_join(alias: str, address: str, scoped: bool) -> str:
    """Joins that bring ``b.current_store_number`` to rows with a store number and a raw address."""
    if scoped:
        return (
            f"LEFT JOIN addresses sa ON {address} = sa.raw LEFT JOIN store_pairs b ON {alias}.store = b.original_store_number AND sa.site = b.site"
        )
    return f"LEFT JOIN store_bridge b ON {alias}.store = b.original_store_number"


def _point(index: int) -> str:
    return f"round(TRY_CAST(translate(string_split(location, ' ')[{index + 1}], '()', '') AS DOUBLE), 6)"


def _corrected(source: str) -> str:
    """Keyed overrides, the city dictionary, coordinates and the standard address (rows without one go)."""
    city = case_sql(f"({case_sql('city', rules.STORE_CITY, 'store')})", rules.CITY)
    return f"""SELECT x.* EXCLUDE (address, city, zip, county, location, raw, site), site AS address, {city} AS city,
      {case_sql('zip', rules.STORE_ZIP, 'store')} AS zip, {case_sql('county', rules.STORE_COUNTY_NUMBER, 'store')} AS county,
      {_point(2)} AS lat, {_point(1)} AS lon FROM (SELECT * FROM {source} k JOIN addresses a ON k.address = a.raw) x"""


def _places(keys: str, source: str, rest: str) -> str:
    """The usual coordinates per place; ``rest`` aggregates columns named lo and hi."""
    return f"""SELECT {keys}, max(CASE WHEN slot = 1 AND rn = 1 THEN v END) AS lat, max(CASE WHEN slot = 2 AND rn = 1 THEN v END) AS lon, {rest} FROM
      (SELECT *, row_number() OVER (PARTITION BY {keys}, slot ORDER BY v IS NULL, n DESC, v) AS rn FROM
        (SELECT {keys}, 1 AS slot, lat AS v, count(*) AS n, min(lo) AS lo, max(hi) AS hi FROM {source} GROUP BY {keys}, lat
         UNION ALL SELECT {keys}, 2, lon, count(*), min(lo), max(hi) FROM {source} GROUP BY {keys}, lon)) GROUP BY {keys}"""


_CITY = f"upper({CLEAN.format('\"City\"')})"
_ZIP = f"TRY_CAST({case_sql('\"Zip Code\"', rules.ZIP_FORMAT)} AS INT)"


def history_ctes(scoped: bool = False) -> str:
    """``history``: the places of every store, numbered."""
    place = "store, address, city, zip, county"
    order = "to_date {0}, address {0}, city {0}, zip {0}, county {0}, lat {0}, lon {0}, from_date {0}"
    return f"""h_clean AS (SELECT DISTINCT "Store Number" AS store, upper("Address") AS address, {_CITY} AS city, {_ZIP} AS zip, "County Number" AS county,
    "Store Location" AS location, "Date" AS day FROM sales WHERE coalesce("Address", "City", "Zip Code", CAST("County Number" AS VARCHAR)) IS NOT NULL),
  h_moved AS (SELECT coalesce(b.current_store_number, c.store) AS store, c.address, city, zip, county, location, day FROM h_clean c {_store_join("c", "c.address", scoped)}),
  h_kept AS (SELECT store, address, city, zip, county, location, min(day) AS lo, max(day) AS hi FROM
    (SELECT *, count(county) OVER (PARTITION BY store, address, city, zip) AS n FROM h_moved) WHERE county IS NOT NULL OR n = 0 GROUP BY ALL),
  h_placed AS ({_corrected("h_kept")}),
  h_places AS ({_places(place, "h_placed", "min(lo) AS from_date, max(hi) AS to_date")}),
  history AS (SELECT 'STO_' || store AS store_number, address, city, zip AS zip_code, 'CNT_' || county AS county_number, lat AS latitude, lon AS longitude,
    from_date, to_date, row_number() OVER (PARTITION BY store ORDER BY {order.format("DESC NULLS LAST")}) = 1 AS is_current,
    CAST(row_number() OVER (PARTITION BY store ORDER BY {order.format("NULLS FIRST")}) AS INT) AS address_sequence FROM h_places)"""


STORE_ADDRESS = f"""s_days AS (SELECT DISTINCT "Store Number" AS store, "Store Name" AS name, "Address" AS address, "City", "Zip Code", "County Number" AS county,
    "Store Location" AS location, "Date" AS day FROM sales),
  s_moved AS (SELECT coalesce(b.current_store_number, d.store) AS store, {INITCAP.format(CLEAN.format("name"))} AS name, upper(address) AS address, {_CITY} AS city,
    {_ZIP} AS zip, county, location, day AS lo, day AS hi FROM s_days d {_store_join("d", "upper(d.address)", False)}),
  s_kept AS (SELECT * EXCLUDE (n) FROM (SELECT *, count(county) OVER (PARTITION BY store) AS n FROM s_moved) WHERE county IS NOT NULL OR n = 0),
  s_placed AS ({_corrected("s_kept")}),
  s_named AS (SELECT p.* EXCLUDE (name), m.name FROM s_placed p LEFT JOIN {mode_sql("store", "name", "s_placed", "name")} m USING (store)),
  s_places AS ({_places("store, name, address, city, zip, county", "s_named", "max(hi) AS day")})"""
STORE_ADDRESS_SELECT = """SELECT 'STO_' || store AS store_number, name AS store_name, address, city, zip AS zip_code, 'CNT_' || county AS county_number,
  lat AS latitude, lon AS longitude FROM s_places QUALIFY row_number() OVER (PARTITION BY store ORDER BY day DESC NULLS LAST, name DESC NULLS LAST,
  address DESC NULLS LAST, city DESC NULLS LAST, zip DESC NULLS LAST, county DESC NULLS LAST, lat DESC NULLS LAST, lon DESC NULLS LAST) = 1"""

CATEGORY = f"""SELECT 'CAT_' || row_number() OVER (ORDER BY name) AS category_number, name AS category_name FROM
  (SELECT DISTINCT {case_sql("name", rules.CATEGORY_NAME)} AS name FROM (SELECT replace({INITCAP.format('"Category Name"')}, '  ', ' ') AS name FROM sales) WHERE name IS NOT NULL)"""
ITEM = f"""i_lines AS (SELECT coalesce(CAST(b.current_item_number AS VARCHAR), s.item) AS item, s.* EXCLUDE (item) FROM
    (SELECT translate("Item Number", 'x', '') AS item, {LABEL} AS label, replace({INITCAP.format('"Category Name"')}, '  ', ' ') AS cat, 'VEN_' || CAST({VENDOR} AS VARCHAR) AS vendor,
     "Pack" AS pack, "Bottle Volume (ml)" AS ml, "State Bottle Cost" AS cost, "State Bottle Retail" AS retail, "Date" AS day FROM sales) s
    LEFT JOIN item_bridge b ON TRY_CAST(s.item AS INT) = b.original_item_number),
  i_labelled AS (SELECT l.* EXCLUDE (label), m.label FROM i_lines l LEFT JOIN {mode_sql("item", "label", "i_lines", "label")} m USING (item)),
  i_named AS (SELECT l.* EXCLUDE (cat), {case_sql("m.cat", rules.CATEGORY_NAME)} AS cat FROM i_labelled l LEFT JOIN {mode_sql("label", "cat", "(SELECT * FROM i_labelled WHERE label IS NOT NULL)", "cat")} m ON l.label = m.label)"""
ITEM_SELECT = f"""SELECT 'ITM_' || item AS item_number, label AS item_description, category_number, vendor AS vendor_number, pack, ml AS bottle_volume_ml,
  cost AS state_bottle_cost, retail AS state_bottle_retail FROM i_named LEFT JOIN ({CATEGORY}) ON cat = category_name
  QUALIFY row_number() OVER (PARTITION BY item, vendor, category_number ORDER BY day DESC NULLS LAST, label DESC NULLS LAST, pack DESC, ml DESC, cost DESC, retail DESC) = 1"""

_PRICE_ORDER = "PARTITION BY item_number, vendor_number ORDER BY to_date {0}, pack {0}, ml {0}, cost {0}, retail {0}, from_date {0}"


def _item_join(line: str, scoped: bool) -> str:
    scope = f" AND 'VEN_' || {line}.vendor = b.vendor_number" if scoped else ""
    return f"LEFT JOIN item_bridge b ON TRY_CAST({line}.item AS INT) = b.original_item_number{scope}"


def price_ctes(scoped: bool = False) -> str:
    """``prices``: the price tuples of every item and vendor, with their sequence."""
    return f"""ranges AS (SELECT 'ITM_' || coalesce(CAST(b.current_item_number AS VARCHAR), s.item) AS item_number, 'VEN_' || s.vendor AS vendor_number,
    pack, ml, cost, retail, min(day) AS from_date, max(day) AS to_date FROM (SELECT translate("Item Number", 'x', '') AS item, CAST({VENDOR} AS VARCHAR) AS vendor, "Pack" AS pack,
    "Bottle Volume (ml)" AS ml, "State Bottle Cost" AS cost, "State Bottle Retail" AS retail, "Date" AS day FROM sales) s
    {_item_join("s", scoped)} GROUP BY 1, 2, 3, 4, 5, 6),
  prices AS (SELECT *, row_number() OVER ({_PRICE_ORDER.format("DESC")}) = 1 AS is_current, CAST(row_number() OVER ({_PRICE_ORDER.format("")}) AS INT) AS price_sequence FROM ranges)"""


PRICES_SELECT = """SELECT item_number, vendor_number, pack, ml AS bottle_volume_ml, cost AS state_bottle_cost, retail AS state_bottle_retail,
  from_date, to_date, is_current, price_sequence FROM prices"""


def line_ctes(scoped: bool = False) -> str:
    """``lines``: the feed's lines with conformed keys, price sequence, measures and standard address."""
    return f"""f_items AS (SELECT s.inv, s.store, s.raw, s.sold, s.day, s.pack, s.ml, s.cost, s.retail, 'VEN_' || s.vendor AS vendor_number,
    'ITM_' || coalesce(CAST(b.current_item_number AS VARCHAR), s.item) AS item_number FROM (SELECT "Invoice/Item Number" AS inv, "Store Number" AS store, upper("Address") AS raw,
    translate("Item Number", 'x', '') AS item, CAST({VENDOR} AS VARCHAR) AS vendor, "Pack" AS pack, "Bottle Volume (ml)" AS ml, "State Bottle Cost" AS cost,
    "State Bottle Retail" AS retail, "Bottles Sold" AS sold, "Date" AS day FROM sales) s {_item_join("s", scoped)}),
  f_priced AS (SELECT f.*, p.price_sequence FROM f_items f LEFT JOIN prices p USING (item_number, vendor_number, pack, ml, cost, retail)),
  lines AS (SELECT inv AS "invoice_item_number", 'STO_' || coalesce(b.current_store_number, f.store) AS store_number, a.site AS address, item_number, vendor_number, price_sequence,
    sold AS items_sold, round(retail * sold, 2) AS sale_dollars, round(round(retail * sold, 2) * {rules.BAHT_PER_DOLLAR}, 2) AS sale_baht,
    CAST(ml AS BIGINT) * sold / 1000 AS volume_sold_liters, day FROM f_priced f JOIN addresses a ON f.raw = a.raw {_store_join("f", "f.raw", scoped)})"""


_LINE = "l.invoice_item_number, l.store_number, l.item_number, l.vendor_number, l.price_sequence, l.items_sold, l.sale_dollars, l.sale_baht, l.volume_sold_liters"
FACT = with_sales(
    f"{TUPLES}, {ITEM_BRIDGE}, {STORE_BRIDGE}, {price_ctes()}, {history_ctes()}, {line_ctes()}",
    f"""SELECT DISTINCT {_LINE}, h.address_sequence, d.day AS date FROM lines l LEFT JOIN history h ON l.store_number = h.store_number AND l.address = h.address
  LEFT JOIN (SELECT DISTINCT "Invoice/Item Number" AS inv, "Date" AS day FROM sales) d ON l.invoice_item_number = d.inv""",
)
# The strict form: the range that holds the day of the line, the latest sequence where ranges overlap.
_ASOF_CTES = f"{TUPLES}, {ITEM_ONES}, {STORE_PAIRS}, {price_ctes(True)}, {history_ctes(True)}, {line_ctes(True)}"
_ASOF = f"""SELECT DISTINCT {_LINE}, l.day AS date, (SELECT max(h.address_sequence) FROM history h WHERE h.store_number = l.store_number
  AND h.address = l.address AND h.from_date <= l.day AND l.day <= h.to_date) AS address_sequence FROM lines l"""
FACT_ASOF = with_sales(_ASOF_CTES, _ASOF)
LINE_REPORT = with_sales(
    f"""{_ASOF_CTES}, fact AS ({_ASOF}),
  before AS (SELECT year("Date") AS year, month("Date") AS month, count(*) AS feed_lines FROM sales GROUP BY 1, 2),
  after AS (SELECT year(date) AS year, month(date) AS month, count(*) AS fact_lines FROM fact GROUP BY 1, 2)""",
    """SELECT CAST(year AS INT) AS year, CAST(month AS INT) AS month, coalesce(feed_lines, 0) AS feed_lines, coalesce(fact_lines, 0) AS fact_lines
  FROM before FULL JOIN after USING (year, month)""",
)
GEO_MODE = with_sales(
    f"""seen AS (SELECT store, city, {_point(2)} AS lat, {_point(1)} AS lon, day AS lo, day AS hi
  FROM (SELECT "Store Number" AS store, "City" AS city, "Store Location" AS location, "Date" AS day FROM sales))""",
    f"""SELECT store AS store_number, city, lat AS latitude, lon AS longitude, lo AS from_date, hi AS to_date
  FROM ({_places("store, city", "seen", "min(lo) AS lo, max(hi) AS hi")})""",
)
