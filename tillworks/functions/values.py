"""Value replacement: conditions, dictionaries, keyed overrides, prefixes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillworks import rules


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_when(c: Column | str, condition: Column, value) -> Column:
    """``value`` where the condition holds; a null condition keeps the old value."""
    return F.when(condition, value).otherwise(_col(c))


def prefer(replacement: Column | str, c: Column | str) -> Column:
    """The replacement, or the old value where there is none."""
    return F.coalesce(_col(replacement), _col(c))


def add_prefix(c: Column | str, prefix: str) -> Column:
    """Prefix the text of ``c``; null stays null."""
    return F.concat(F.lit(prefix), _col(c).cast("string"))


def _lookup(mapping: dict, key: Column) -> Column:
    # One literal map and one lookup: a chain of conditionals would leave one
    # projection per entry in the plan.
    entries = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.try_element_at(entries, key)


def correct_values(c: Column | str, corrections: dict) -> Column:
    """Exact-match dictionary replacement; values not in the dictionary stay."""
    c = _col(c)
    return F.coalesce(_lookup(corrections, c), c) if corrections else c


def override_by_key(c: Column | str, key: Column | str, overrides: dict) -> Column:
    """Replace ``c`` in the rows whose ``key`` is listed."""
    c = _col(c)
    return F.coalesce(_lookup(overrides, _col(key)), c) if overrides else c


def fix_vendor(number: Column | str, name: Column | str) -> Column:
    """The vendor number as text, with the split vendor folded into one number.

    The name is compared without regard to case, so that every table agrees.
    """
    return replace_when(
        _col(number).cast("string"),
        F.upper(_col(name)) == rules.SPLIT_VENDOR_NAME,
        str(rules.SPLIT_VENDOR_NUMBER),
    )
