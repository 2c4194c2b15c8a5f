"""Where entities are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def located(rows: DataFrame) -> DataFrame:
    """Rows with both coordinates known."""
    return rows.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def count_by_type(rows: DataFrame) -> DataFrame:
    """Number of located entities per entity type."""
    return located(rows).groupBy("entity_type").agg(F.count(F.lit(1)).alias("entities"))


def listing_by_type(rows: DataFrame) -> DataFrame:
    """Located entities by type, then name and coordinates."""
    ordered = located(rows).orderBy("entity_type", "name", "latitude", "longitude")
    return ordered.select("entity_type", "name", "latitude", "longitude")
