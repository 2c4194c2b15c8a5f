"""Resource paths: building them, routing them and how long a stored response stays fresh."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path layout and freshness limits in seconds.
_LIVE = r"^/entity/[^/]+/live$"
_SCHEDULE = r"^/entity/[^/]+/schedule(/\d+/\d+)?$"
_CHILDREN = r"^/entity/[^/]+/children$"
_ENTITY = r"^/entity/[^/]+$"
_DESTINATIONS = "/destinations"
TTL_SECONDS = {"destinations": 3600, "entity": 3600, "children": 3600, "schedule": 300}
LONGEST_TTL = max(TTL_SECONDS.values())


def path_encode(text: Column) -> Column:
    """Percent-encode everything but unreserved characters (form encoding corrected to path encoding)."""
    form = F.url_encode(text)
    return F.replace(
        F.replace(F.replace(form, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")),
        F.lit("%7E"),
        F.lit("~"),
    )


def path_decode(text: Column) -> Column:
    """Inverse of `path_encode`; null for a broken escape."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def entity_path(entity_id: Column) -> Column:
    return F.concat(F.lit("/entity/"), path_encode(entity_id))


def month_path(entity_id: Column, year: Column, month: Column) -> Column:
    """Path of one schedule page; the month is padded to two digits, the year is not padded."""
    return page_path(entity_path(entity_id), year, month)


def page_path(entity: Column, year: Column, month: Column) -> Column:
    """`month_path` below the path of an entity."""
    return F.concat(
        entity,
        F.lit("/schedule/"),
        year.cast("string"),
        F.lit("/"),
        F.lpad(month.cast("string"), 2, "0"),
    )


def endpoint(path: Column) -> Column:
    """Which kind of resource a path names; `other` for anything unknown."""
    return (
        F.when(path.rlike(_LIVE), "live")
        .when(path.rlike(_SCHEDULE), "schedule")
        .when(path.rlike(_CHILDREN), "children")
        .when(path.rlike(_ENTITY), "entity")
        .when(path == _DESTINATIONS, "destinations")
        .otherwise("other")
    )


def path_entity_id(path: Column) -> Column:
    """Decoded entity id of an entity path, else null."""
    segment = F.regexp_extract(path, r"^/entity/([^/]+)(/|$)", 1)
    return F.when(segment != "", path_decode(segment))


def _page_part(path: Column, group: int) -> Column:
    part = F.regexp_extract(path, r"/schedule/(\d+)/(\d+)$", group)
    return part.try_cast("int")


def path_year(path: Column) -> Column:
    return _page_part(path, 1)


def path_month(path: Column) -> Column:
    return _page_part(path, 2)


def ttl_seconds(kind: Column) -> Column:
    """Freshness limit of an endpoint; live and unknown resources are never fresh."""
    limits = F.create_map(*[F.lit(part) for pair in TTL_SECONDS.items() for part in pair])
    return F.coalesce(F.try_element_at(limits, kind), F.lit(0))
