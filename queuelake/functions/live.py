"""Expressions over one live entry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def current_wait_time(queue: Column) -> Column:
    """Standby wait in whole minutes, truncated; null when none is reported or it is not finite."""
    return queue["STANDBY"]["waitTime"].try_cast("bigint")


def price_label(price: Column) -> Column:
    """Formatted price, or `?` when the offer has no price at all."""
    return F.when(price.isNull(), "?").otherwise(price["formatted"])
