"""What has to be fetched: the paths of many range requests, less what is still fresh."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuelake.functions import paths
from queuelake.operators.schedule import asked_dates, asked_months


def month_paths(requests: DataFrame) -> DataFrame:
    """Every request `(req_id, entity_id, start_date, end_date)` with the pages it needs."""
    asked = asked_months(requests)
    page = paths.month_path(F.col("entity_id"), F.col("year"), F.col("month"))
    return asked.select("req_id", page.alias("path"))


def manifest(requests: DataFrame) -> DataFrame:
    """Distinct pages a table of range requests needs.

    Ranges shrink to spans of pages, and an entity's spans are taken by their start: each adds the pages behind the
    furthest end before it. So only spans travel and are held, and pages, however many, come once each.
    """
    start, end = asked_dates()
    entity = paths.entity_path(F.col("entity_id"))
    # Without an entity there is no page, and one row says so.
    spans = requests.where(start <= end).select(
        entity.alias("entity"), *[F.when(entity.isNull(), 0).otherwise(F.year(d) * 12 + F.month(d) - 1).alias(n) for n, d in (("first", start), ("last", end))]
    )
    furthest = spans.groupBy("entity", "first").agg(F.max("last").alias("last"))
    before = Window.partitionBy("entity").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    told = furthest.withColumn("first", F.greatest("first", F.max("last").over(before) + 1)).where("first <= last")
    pages = told.select("entity", F.explode(F.sequence("first", "last")).alias("page"))
    return pages.select(paths.page_path(F.col("entity"), F.floor(F.col("page") / 12), F.pmod("page", F.lit(12)) + 1).alias("path"))


def to_fetch(wanted: DataFrame, stored: DataFrame, now: dt.datetime | Column) -> DataFrame:
    """Paths of `wanted` with no usable response that is still fresh at `now`; live paths always.

    The newest response per path decides, and keys alone travel through the aggregate.
    """
    moment = now if isinstance(now, Column) else F.lit(now)
    limit = paths.ttl_seconds(paths.endpoint(F.col("path")))
    known = stored.where(F.col("status").between(200, 299) & (F.col("fetched_at") <= moment))
    newest = known.groupBy("path").agg(
        F.max(F.struct("fetched_at", "seq", F.col("body").isNotNull().alias("usable"))).alias("n")
    )
    age_limit = F.unix_micros("n.fetched_at") + limit.cast("long") * 1_000_000
    fresh = newest.where(F.col("n.usable") & (F.unix_micros(moment) < age_limit)).select("path")
    return wanted.join(fresh, "path", "left_anti")
