"""Loose text comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize(text: Column) -> Column:
    """Lower-cased letters and digits only, so spelling, case and punctuation do not matter."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def loosely_matches(needle: Column, *labels: Column) -> Column:
    """Does any label contain the (already normalized) needle? Null labels never match."""
    found = F.lit(False)
    for label in labels:
        found = found | F.coalesce(F.contains(normalize(label), needle), F.lit(False))
    return (F.length(needle) > 0) & found
