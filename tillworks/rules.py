"""Rule data: correction dictionaries, keyed overrides, address rules."""

# They must equal the published rule set for results to match.

CATEGORY_NAME = {
    "Cocktails /rtd": "Cocktails / Rtd",
    "American Cordials & Liqueur": "American Cordials & Liqueurs",
    "Imported Cordials & Liqueur": "Imported Cordials & Liqueurs",
    "American Distilled Spirit Specialty": "American Distilled Spirits Specialty",
    "Imported Distilled Spirit Specialty": "Imported Distilled Spirits Specialty",
}

VENDOR_NAME = {
    "3 BADGE MIXOLOGY": "3 BADGE CORPORATION",
    "A HARDY / USA": "A HARDY USA",
    "A V BRANDS": "AVENIU BRANDS",
    "ANCHOR DISTILLING (PREISS IMPORTS)": "ANCHOR DISTILLING",
    "BLAUM BROS DISTILLING": "BLAUM BROTHERS DISTILLING",
    "BROADBENT VENTURES": "BROADBENT DISTILLERY",
    "BROWN FORMAN": "BROWN-FORMAN CORPORATION",
    "CAMPARI(SKYY)": "SKYY SPIRITS",
    "CONSTELLATION BRANDS": "CONSTELLATION WINE COMPANY",
    "COOPERSPIRITSINTERNATIONAL": "COOPER SPIRITS INTERNATIONAL",
    "DUGGANS DISTILLERS": "DUGGAN'S DISTILLERS PRODUCTS",
    "DUNKEL CORPORATION": "IOWA DISTILLING COMPANY",
    "DUNKEL CORPORATION / IOWA DISTILLING": "IOWA DISTILLING COMPANY",
    "DOMAINE SELECT": "DOMAINE SELECT WINE ESTATES",
    "FRANK LIN DISTILLERS PRO": "FRANK-LIN DISTILLERS PRODUCTS",
    "GOAMERICAGO BEVERAGES LLC / WHISTLEPIG": "GOAMERICAGO BEVERAGES",
    "GUNSANDMORE.INFO": "GUNSANDMORE INFO",
    "GUNSANDMOREINFO": "GUNSANDMORE INFO",
    "HOTALING AND CO": "ANCHOR DISTILLING",
    "HOTALING AND": "ANCHOR DISTILLING",
    "INFINIUM SPIRITS": "WILSON DANIELS",
    "IMPEX BEVERAGE": "IMPEX BEVERAGES",
    "JDSO INC / RED BOOT DISTILLERY": "RED BOOT DISTILLERY",
    "KINDRED SPIRIT N AMERICA": "KINDRED SPIRITS OF NORTH AMERICA",
    "KOBRAND": "KOBRAND CORPORATION",
    "LUXCO": "LUXCO-ST LOUIS",
    "LEVECKE": "LEVECKE CORPORATION",
    "JESSE JAMES DISTILLING COMPANY": "LEVECKE CORPORATION",
    "MAST-JAGERMEISTER US": "SIDNEY FRANK IMPORTING COMPANY",
    "MAST-JAEGERMEISTER US": "SIDNEY FRANK IMPORTING COMPANY",
    "MARSALLE COMPANY/STOLLER WAREHOUSE": "STOLLER WAREHOUSE",
    "MCCORMICK DISTILLING": "MCCORMICK DISTILLING COMPANY",
    "MODERN SPIRIT": "MODERN SPIRITS",
    "MISSISSIPPI RIVER DISTIL": "MISSISSIPPI RIVER DISTILLING",
    "OREGON BREWING": "ROGUE ALES AND SPIRITS",
    "PALM BAY IMPORTS": "PALM BAY INTERNATIONAL",
    "PATERNO IMPORTS LTD / TERLATO WINES INTERNATIONAL": "PATERNO IMPORTS",
    "PATRON SPIRITS COMPANY": "THE PATRON SPIRITS COMPANY",
    "PERNOD RICARD USA/AUSTIN NICHOLS": "PERNOD RICARD USA",
    "PHILLIPS BEVERAGE": "PHILLIPS BEVERAGE COMPANY",
    "PURPLE VALLEY IMPORTS / GLASS REVOLUTION IMPORTS": "PURPLE VALLEY IMPORTS",
    "R�MY COINTREAU USA": "REMY COINTREAU USA",
    "RUSSIAN STANDARD VODKA": "RUSSIAN STANDARD VODKA USA",
    "RUSSIAN STANDARD VODKA, USA": "RUSSIAN STANDARD VODKA USA",
    "SANDB FARMS DISTILLERY": "S AND B FARMSTEAD DISTILLERY",
    "SANDB FARMSTEAD DISTILLERY": "S AND B FARMSTEAD DISTILLERY",
    "SAZERAC CO": "SAZERAC COMPANY",
    "SHAW-ROSS INTERNATIONAL": "SHAW ROSS INTERNATIONAL IMPORTERS",
    "SIDNEY FRANK IMPORTING": "SIDNEY FRANK IMPORTING COMPANY",
    "STOLLER IMPORTS INC / MARSALLE COMPANY": "MARSALLE COMPANY",
    "STOLLLER WAREHOUSE": "STOLLER WAREHOUSE",
    "ST GEORGE SPIRIT": "ST GEORGE SPIRITS",
    "SUTTER HOME WINERY INC / TRINCHERO FAMILY ESTATES": "SUTTER HOME WINERY",
    "TRINCHERO FAMILY ESTATES": "SUTTER HOME WINERY",
    "TY KU": "DAVOS BRANDS",
    "VINO COM": "TOTAL BEVERAGE SOLUTIONS",
    "VISION WINE AND SPIRIT": "VISION WINE AND SPIRITS",
    "WESTERN SPIRITS BEVERAGE CO": "WESTERN SPIRITS BEVERAGE",
    "WILDMAN AND SONS F": "FREDRICK WILDMAN AND SON",
    "WINE IS FINE INC": "ANCHOR DISTILLING",
    "WHISTLEPIG": "GOAMERICAGO BEVERAGES",
    "WINE IS FINE": "ANCHOR DISTILLING",
}

ADDRESS = {
    "101 COMERICAL STREET": "101 COMERCIAL STREET",
    "1011 SOUTH FREDERICK M/A": "1011 SOUTH FREDERICK",
    "106 SOUTH 16": "106 SOUTH 16TH",
    "1107 SOUTH 16": "1107 SOUTH 16TH",
    "1119 MARKET BOX 71": "1119 MARKET",
    "1203 5": "1203 5TH",
    "1219 1ST": "1219 1ST AVENUE",
    "1300 NICOLAUS": "1300 NICOLAUS DRIVE",
    "1300 WEST BURLINGTON": "1300 WEST BURLINGTON AVENUE",
    "1303 NORTH FEDERAL": "1303 NORTH FEDERAL AVENUE",
    "1320 EAST EUCLID": "1320 EAST EUCLID AVENUE",
    "1907 STEVENS DRIVE UNITS C-EAST": "1907 STEVENS DRIVE UNIT C-EAST",
    "209 EAST LECLAIRE ROAD": "209 EAST LE CLAIRE ROAD",
    "2108 ISSAC NEWTON DRIVE": "2108 ISAAC NEWTON DRIVE",
    "215 WEST MILWAUKEE": "215 WEST MILWAUKEE AVENUE",
    "2325 7TH AVENUE NORTH NORTH": "2325 7TH AVENUE NORTH",
    "2424 SOUTHWEST 9TH #1": "2424 SOUTHWEST 9TH",
    "2424 SOUTHWEST 9TH # 1": "2424 SOUTHWEST 9TH",
    "2810 WILLS AVENUE": "2810 WILLIS AVENUE",
    "2839 EAST UNIVERSITY": "2839 EAST UNIVERSITY AVENUE",
    "3100 SOUTHEAST GRIMES BLVD SUITE 100": "3100 SOUTHEAST GRIMES BLVD STE 100",
    "315 STORU": "315 STORY",
    "3594 LAFAYETTE": "3594 LAFAYETTE ROAD",
    "3804 HUBBELL": "3804 HUBBELL AVENUE",
    "4141 CENTERPOINT ROAD NORTHEAST": "4141 CENTER POINT ROAD NORTHEAST",
    "4685 NORTHWEST 2ND": "4685 NORTHWEST 2ND AVENUE",
    "7 GOETHE SUITE B": "7 GOETHE STE B",
    "700 RHOMBERGE AVENUE": "700 RHOMBERG AVENUE",
    "7229 UNIVERSTY AVENUE": "7229 UNIVERSITY AVENUE",
    "903 NORTH SUMNER AVENUE": "903 NORTH SUMMER AVENUE",
}

CITY = {
    "CLEARLAKE": "CLEAR LAKE",
    "FT ATKINSON": "FORT ATKINSON",
    "GRAND MOUNDS": "GRAND MOUND",
    "GUTTENBURG": "GUTTENBERG",
    "KELLOG": "KELLOGG",
    "LEMARS": "LE MARS",
    "MT PLEASANT": "MOUNT PLEASANT",
    "MT VERNON": "MOUNT VERNON",
    "OTTUWMA": "OTTUMWA",
    "OTUMWA": "OTTUMWA",
    "SAINT ANSGAR": "ST ANSGAR",
}

COUNTY_NAME = {
    "BUENA VIST": "BUENA VISTA",
    "CERRO GORD": "CERRO GORDO",
    "OBRIEN": "O'BRIEN",
    "POTTAWATTA": "POTTAWATTAMIE",
}

ZIP_FORMAT = {"712-2": "51529"}

STORE_CITY = {3822: "SWISHER", 5136: "URBANDALE"}

STORE_ZIP = {2514: 52302, 3805: 52804, 5097: 52403, 2656: 50841, 5091: 52761, 5276: 51573}

STORE_COUNTY_NUMBER = {
    4320: 25,
    4944: 91,
    4067: 92,
    2656: 2,
    3461: 39,
    5012: 25,
    5882: 64,
    5998: 70,
    5220: 17,
    5276: 69,
    5280: 17,
    5287: 99,
}

# Applied in this order; each is a regular expression and its replacement.
ADDRESS_PATTERNS = [
    (r"\bHWY\b", "HIGHWAY"),
    (r"\bDR\b", "DRIVE"),
    (r"\bAVE\b", "AVENUE"),
    (r"\bST\b", "STREET"),
    (r"\bRD\b", "ROAD"),
    (r"\bN\b", "NORTH"),
    (r"\bE\b", "EAST"),
    (r"\bS\b", "SOUTH"),
    (r"\bW\b", "WEST"),
    (r"\bNE\b", "NORTHEAST"),
    (r"\bNW\b", "NORTHWEST"),
    (r"\bSE\b", "SOUTHEAST"),
    (r"\bSW\b", "SOUTHWEST"),
    (r"\bSTREET\b", ""),
    (r"PO B.*", ""),
]

# Characters dropped from names, cities and addresses, and from item descriptions.
NAME_NOISE = "\"'.,"
DESCRIPTION_NOISE = ".\"'�°"
ITEM_NUMBER_NOISE = "x"

# The one vendor that arrives under several numbers.
SPLIT_VENDOR_NAME = "RESERVOIR DISTILLERY"
SPLIT_VENDOR_NUMBER = 988

BAHT_PER_DOLLAR = 36
CALENDAR_OFFSET_YEARS = 543
FEED_DATE_FORMAT = "MM/dd/yyyy"
FIRST_CHECKPOINT = (2011, 12)

CATEGORY_PREFIX = "CAT_"
VENDOR_PREFIX = "VEN_"
ITEM_PREFIX = "ITM_"
STORE_PREFIX = "STO_"
COUNTY_PREFIX = "CNT_"
