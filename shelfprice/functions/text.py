"""Text cleaning. Every function maps a Column to a Column and stays inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, sentinels and the city-to-region table of the source data.
BRANCH_PATTERN = "^Branch_[a-zA-Z0-9]+$"
NOT_APPLICABLE_VALUES = ["NOT_APPLICABLE", "N/A", "NONE", "", "Not_Applicable"]
REGION_CITIES = {
    "Greater Cairo": ["CAIRO", "GIZA"],
    "Alex Coast": ["ALEXANDRIA"],
    "Delta": ["TANTA", "MANSOURA"],
}

# ASCII punctuation and control characters; a plain class of single characters (a table, not ranges) is the cheapest to match.
_PUNCTUATION = "[" + "".join(f"\\x{i:02x}" for i in range(128) if i != 32 and not chr(i).isalnum()) + "]"
# A private-use character marks the word breaks that initcap does not know about.
_BREAK = "\ue000 "


def title(c: Column) -> Column:
    """Trim, then capitalise each run of letters and digits.

    ``initcap`` alone breaks words at blanks only; underscore, dash and other
    punctuation must break them too (``STORE_EXPENSE`` -> ``Store_Expense``).
    """
    marked = F.regexp_replace(F.trim(c), _PUNCTUATION, "$0" + _BREAK)
    return F.replace(F.initcap(marked), F.lit(_BREAK), F.lit(""))


def clean_title_case(c: Column) -> Column:
    """Title-cased text; blank becomes NULL."""
    return F.when(F.trim(c) != "", title(c))


def clean_with_pattern(c: Column, pattern: str = BRANCH_PATTERN, titled: Column | None = None) -> Column:
    """Title-cased text when the trimmed value matches ``pattern``, else NULL."""
    return F.when(F.trim(c).rlike(pattern), title(c) if titled is None else titled)


def validate_allowed_values(c: Column, allowed: Sequence[str], titled: Column | None = None) -> Column:
    """Title-cased text when the value is allowed (any case), else NULL."""
    known = F.upper(F.trim(c)).isin([v.upper() for v in allowed])
    return F.when(known, title(c) if titled is None else titled)


def map_store_region(city: Column, region: Column, titled: Column | None = None) -> Column:
    """Region of a known city; otherwise the cleaned region text."""
    name = F.upper(F.trim(city))
    mapped = F.lit(None).cast("string")
    for target, cities in REGION_CITIES.items():
        mapped = F.when(name.isin(cities), F.lit(target)).otherwise(mapped)
    return F.coalesce(mapped, clean_title_case(region) if titled is None else titled)


def clean_title_cases(*columns: Column) -> Column:
    """``clean_title_case`` of many columns at once, as an array.

    A wide cleaning projection with the expression spelled out per column
    generates a method too large for the JVM to compile; mapped over an array
    it appears once. The ``titled`` argument of the functions above takes an
    element of this array.
    """
    return F.transform(F.array(*columns), clean_title_case)


def handle_not_applicable(c: Column, replacement: str = "Non-Product Expense") -> Column:
    """Replace NULL and not-applicable markers; the result is always a string."""
    text = c.cast("string")
    absent = text.isNull() | F.trim(text).isin(NOT_APPLICABLE_VALUES)
    return F.when(absent, F.lit(replacement)).otherwise(text)
