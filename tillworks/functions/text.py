"""Text cleaning as Column expressions.

Single characters are dropped with ``translate`` and fixed strings swapped with
``replace``; regular expressions are left for what needs them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillworks import rules
from tillworks.functions.values import correct_values


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def initcap_words(c: Column | str) -> Column:
    """First letter of each whitespace-separated word upper, the rest lower."""
    return F.initcap(_col(c))


def upper_text(c: Column | str) -> Column:
    """Upper case; numbers turn into their text."""
    return F.upper(_col(c).cast("string"))


def trim_spaces(c: Column | str) -> Column:
    return F.trim(_col(c))


def squeeze_spaces(c: Column | str, fully: bool = False) -> Column:
    """Two spaces become one, in a single pass; ``fully`` squeezes runs of any length."""
    if fully:
        return F.regexp_replace(_col(c), " {2,}", " ")
    return F.replace(_col(c), F.lit("  "), F.lit(" "))


def drop_characters(c: Column | str, characters: str) -> Column:
    return F.translate(_col(c), characters, "")


def remove_patterns(c: Column | str, patterns: list[str]) -> Column:
    """Delete every match of each regular expression, in the order given."""
    return reduce(lambda done, p: F.regexp_replace(done, p, ""), patterns, _col(c))


def replace_pattern(c: Column | str, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(_col(c), pattern, replacement)


def clean_text(c: Column | str, case: str | None = None) -> Column:
    """Clean a name, city or address; ``case`` is ``"upper"``, ``"initcap"`` or ``None``."""
    bare = squeeze_spaces(drop_characters(c, rules.NAME_NOISE))
    spelled = trim_spaces(F.replace(bare, F.lit("&"), F.lit("and")))
    if case is None:
        return spelled
    if case == "upper":
        return upper_text(spelled)
    if case == "initcap":
        return initcap_words(spelled)
    raise ValueError(f"unknown case {case!r}")


def clean_description(c: Column | str, noise: str = rules.DESCRIPTION_NOISE) -> Column:
    return initcap_words(drop_characters(c, noise))


def clean_item_number(c: Column | str) -> Column:
    return drop_characters(c, rules.ITEM_NUMBER_NOISE)


def clean_category(c: Column | str) -> Column:
    """A category name in title case, double spaces squeezed."""
    return squeeze_spaces(initcap_words(c))


def standardize_address(
    c: Column | str,
    patterns: list[tuple[str, str]] = rules.ADDRESS_PATTERNS,
    corrections: dict[str, str] = rules.ADDRESS,
) -> Column:
    """Spell abbreviations out, drop street words and box numbers, correct the rest."""
    spelled = clean_text(c, "upper")
    for pattern, replacement in patterns:
        spelled = F.regexp_replace(spelled, pattern, replacement)
    return correct_values(trim_spaces(squeeze_spaces(spelled)), corrections)
