"""Schedules between dates, for one range or for a table of ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuelake.functions.times import months_between_inclusive


def _page_number() -> Column:
    return F.col("year") * 12 + F.col("month")


def entries_between(
    entries: DataFrame, start: dt.date, end: dt.date, entity_id: str | None = None
) -> DataFrame:
    """Entries dated within `[start, end]` on the month pages the range touches.

    Dates compare as ISO text. The page predicate prunes a table stored by year and month. Overlapping
    pages are not deduplicated. An `end` before `start` gives no rows.
    """
    first, last = start.year * 12 + start.month, end.year * 12 + end.month
    pages = entries.where(F.col("year").between(start.year, end.year))
    pages = pages.where(_page_number().between(first, last))
    if entity_id is not None:
        pages = pages.where(F.col("entity_id") == entity_id)
    return pages.where(F.col("date").between(start.isoformat(), end.isoformat()))


def range_report(
    entries: DataFrame, start: dt.date, end: dt.date, entity_id: str | None = None
) -> DataFrame:
    """`entries_between` by date, then page, then page order."""
    return entries_between(entries, start, end, entity_id).orderBy("date", "year", "month", "seq", "ord")


def of_type(entries: DataFrame, kind: str) -> DataFrame:
    return entries.where(F.col("type") == kind)


def _asked(column: str) -> Column:
    return F.col(column).try_cast("date")


def asked_dates() -> tuple[Column, Column]:
    """Start and end of a range request; null where they are no dates."""
    return _asked("start_date"), _asked("end_date")


def bad_requests(requests: DataFrame) -> DataFrame:
    """Range requests whose start or end is not a date."""
    return requests.where(_asked("start_date").isNull() | _asked("end_date").isNull())


def asked_months(requests: DataFrame) -> DataFrame:
    """Requests once per month page they touch; reversed ranges and `bad_requests` touch none."""
    start, end = asked_dates()
    months = requests.select("*", F.explode(months_between_inclusive(start, end)).alias("_m"))
    return months.select(
        "*", F.year("_m").alias("year"), F.month("_m").alias("month")
    ).drop("_m")


def request_months(requests: DataFrame) -> DataFrame:
    """`(req_id, year, month)` of every page a range request needs."""
    return asked_months(requests).select("req_id", "year", "month")


def ranges(requests: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries of many requests `(req_id, entity_id, start_date, end_date)` at once.

    The join is on entity, year and month, with the date range checked inside a page: a long history or
    a busy entity spreads over its pages, and a table stored by month prunes to the months asked for.
    """
    asked = asked_months(requests).select(
        "req_id",
        "entity_id",
        "year",
        "month",
        F.date_format(_asked("start_date"), "yyyy-MM-dd").alias("_from"),
        F.date_format(_asked("end_date"), "yyyy-MM-dd").alias("_to"),
    )
    hits = entries.join(asked, ["entity_id", "year", "month"])
    return hits.where(F.col("date").between(F.col("_from"), F.col("_to"))).drop("_from", "_to")


def range_counts(requests: DataFrame, entries: DataFrame) -> DataFrame:
    """Number of entries per request, 0 included, by running totals: two lookups a request, however long its range.

    Entries shrink to a count per entity and date before the shuffle. A running total over an entity's dates, among
    them those that requests ask about, gives what lies up to each; a request takes the total at its end less that at
    the day before its start. An entity has at most as many rows as there are dates. Entries that lie on the page of
    another month than their date's, or whose date is none, are counted by the join of `ranges`.
    """
    day = F.when(F.col("date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.col("date").try_cast("date"))
    at_home = F.coalesce((F.year(day) == F.col("year")) & (F.month(day) == F.col("month")), F.lit(False))
    daily = entries.groupBy("entity_id", "year", "month", "date").agg(F.count(F.lit(1)).alias("n"))

    asked = requests.select("req_id", "entity_id", _asked("start_date").alias("first"), _asked("end_date").alias("last")).where("first <= last")
    ends = F.array(F.struct(F.date_sub("first", 1).alias("day"), F.lit(-1).alias("sign")), F.struct(F.col("last").alias("day"), F.lit(1).alias("sign")))
    looked_up = asked.select("req_id", "entity_id", F.explode(ends).alias("e")).select("req_id", "entity_id", "e.day", "e.sign")
    dates = daily.where(at_home).select("entity_id", day.alias("day"), "n")
    moments = dates.unionByName(looked_up.select("entity_id", "day").distinct().withColumn("n", F.lit(0).cast("bigint")))
    moments = moments.groupBy("entity_id", "day").agg(F.sum("n").alias("n"))
    so_far = Window.partitionBy("entity_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    totals = moments.select("entity_id", "day", F.sum("n").over(so_far).alias("total"))
    found = looked_up.join(totals, ["entity_id", "day"]).select("req_id", (F.col("sign") * F.col("total")).alias("n"))

    strays = ranges(requests, daily.where(~at_home)).select("req_id", "n")
    counted = found.unionByName(strays).groupBy("req_id").agg(F.sum("n").alias("entries"))
    return (
        requests.select("req_id")
        .join(counted, "req_id", "left")
        .select("req_id", F.coalesce("entries", F.lit(0)).alias("entries"))
    )
