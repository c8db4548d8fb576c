"""Column expressions over arrays of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as str.strip() and SQL's trim of [[:space:]] see it, spelled out for Java's regex engine.
EDGES = r"(?U)^\s+|\s+$"


def stripped(text: Column) -> Column:
    """text without white space at its ends."""
    return F.regexp_replace(text, EDGES, "")


def clean_items(items: Column) -> Column:
    """Distinct items, lower-cased, without white space at the ends, nulls and blanks; null stays null."""
    return F.array_distinct(F.filter(F.transform(items, lambda x: F.lower(stripped(x))), lambda x: x.isNotNull() & (x != "")))
