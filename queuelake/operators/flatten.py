"""From valid documents to typed rows.

Every function takes documents of one kind (see `queuelake.sources.validate.documents`) and keeps
`seq` (which response) and `ord` (position inside it), which together carry the payload order.
Missing, null and empty lists all give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelake.functions.numbers import lax_boolean, lax_double
from queuelake.functions.times import aware_instant
from queuelake.schemas import QUEUE_VARIANTS, WAIT_VARIANTS

_KEYS = ("seq", "path", "fetched_at")


def _present(record: str, **fields: str) -> str:
    """SQL record of typed fields that stays null when the landed record is: an absent record and one
    whose fields are all null remain different."""
    members = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return f"CASE WHEN {record} IS NOT NULL THEN named_struct({members}) END"


def _price(price: str) -> str:
    return _present(
        price,
        amount=lax_double(f"{price}.amount"),
        currency=f"{price}.currency",
        formatted=f"{price}.formatted",
    )


def _wait(queue: str) -> str:
    return _present(queue, waitTime=lax_double(f"{queue}.waitTime"))


def _return(queue: str, **more: str) -> str:
    return _present(
        queue,
        state=f"{queue}.state",
        returnStart=aware_instant(f"{queue}.returnStart"),
        returnEnd=aware_instant(f"{queue}.returnEnd"),
        **more,
    )


def _boarding(queue: str) -> str:
    return _present(
        queue,
        allocationStatus=f"{queue}.allocationStatus",
        currentGroupStart=lax_double(f"{queue}.currentGroupStart"),
        currentGroupEnd=lax_double(f"{queue}.currentGroupEnd"),
        nextAllocationTime=aware_instant(f"{queue}.nextAllocationTime"),
        estimatedWait=lax_double(f"{queue}.estimatedWait"),
    )


def typed_queue(queue: str) -> Column:
    """Typed form of a landed queue record; absent variants stay null, empty ones stay present."""
    typed = {v: _wait(f"{queue}.{v}") for v in WAIT_VARIANTS}
    typed["RETURN_TIME"] = _return(f"{queue}.RETURN_TIME")
    paid = f"{queue}.PAID_RETURN_TIME"
    typed["PAID_RETURN_TIME"] = _return(paid, price=_price(f"{paid}.price"))
    typed["BOARDING_GROUP"] = _boarding(f"{queue}.BOARDING_GROUP")
    return F.expr(_present(queue, **{v: typed[v] for v in QUEUE_VARIANTS}))


def _double(text: str, name: str) -> Column:
    return F.expr(lax_double(text)).alias(name)


def _instant(text: str, name: str) -> Column:
    return F.expr(aware_instant(text)).alias(name)


def _location(location: str) -> list[Column]:
    return [
        _double(f"{location}.latitude", "latitude"),
        _double(f"{location}.longitude", "longitude"),
    ]


def destinations(documents: DataFrame) -> DataFrame:
    """Directory entries in list order, each still holding its parks."""
    rows = documents.select(*_KEYS, F.posexplode("doc.destinations").alias("ord", "_d"))
    return rows.select(
        *_KEYS, "ord", "_d.id", "_d.name", "_d.slug", F.col("_d.externalId").alias("external_id"), "_d.parks"
    )


def destination_parks(directory: DataFrame) -> DataFrame:
    """Parks of every directory entry."""
    rows = directory.select(
        *_KEYS, F.col("id").alias("destination_id"), F.posexplode("parks").alias("park_ord", "_p")
    )
    return rows.select(
        *_KEYS, "destination_id", "park_ord", F.col("_p.id").alias("park_id"), F.col("_p.name").alias("park_name")
    )


def entities(documents: DataFrame) -> DataFrame:
    """Entity records with coordinates flattened and tags kept as a list."""
    doc = F.col("doc")
    return documents.select(
        *_KEYS,
        doc["id"].alias("id"),
        doc["name"].alias("name"),
        doc["entityType"].alias("entity_type"),
        doc["parentId"].alias("parent_id"),
        doc["destinationId"].alias("destination_id"),
        doc["timezone"].alias("timezone"),
        *_location("doc.location"),
        doc["tags"].alias("tags"),
    )


def tags(entity_rows: DataFrame) -> DataFrame:
    """Tags of every entity: what kind of value each carries, and the value itself as a variant."""
    rows = entity_rows.select(*_KEYS, F.col("id").alias("entity_id"), F.posexplode("tags").alias("ord", "_t"))
    value = F.col("_t.value")
    kind = F.schema_of_variant(value)
    value_kind = (
        F.when(kind == "STRING", "STRING")
        .when(F.startswith(kind, F.lit("OBJECT")), "OBJECT")
        .when(kind == "VOID", F.lit(None).cast("string"))
        .when(kind.isNotNull(), "NUMBER")
    )
    return rows.select(
        *_KEYS,
        "entity_id",
        "ord",
        "_t.tag",
        F.col("_t.tagName").alias("tag_name"),
        F.col("_t.id").alias("tag_id"),
        value_kind.alias("value_kind"),
        value.alias("value"),
    )


def descendants(documents: DataFrame) -> DataFrame:
    """Everything below the root a children document was asked for, in payload order, root excluded."""
    rows = documents.select(
        *_KEYS, F.col("doc.id").alias("root_id"), F.posexplode("doc.children").alias("ord", "_c")
    )
    child = F.col("_c")
    return rows.select(
        *_KEYS,
        "root_id",
        "ord",
        child["id"].alias("id"),
        child["name"].alias("name"),
        child["entityType"].alias("entity_type"),
        child["externalId"].alias("external_id"),
        child["parentId"].alias("parent_id"),
        *_location("_c.location"),
    )


def live(documents: DataFrame) -> DataFrame:
    """One row per live entry, with its queue typed and its lists kept."""
    rows = documents.select(
        *_KEYS, F.col("doc.id").alias("root_id"), F.posexplode("doc.liveData").alias("ord", "_e")
    )
    entry = F.col("_e")
    return rows.select(
        *_KEYS,
        "root_id",
        "ord",
        entry["id"].alias("id"),
        entry["name"].alias("name"),
        entry["entityType"].alias("entity_type"),
        entry["status"].alias("status"),
        _instant("_e.lastUpdated", "last_updated"),
        typed_queue("_e.queue").alias("queue"),
        entry["showtimes"].alias("showtimes"),
        entry["operatingHours"].alias("operating_hours"),
        entry["diningAvailability"].alias("dining"),
    )


def _hours(live_rows: DataFrame, column: str) -> DataFrame:
    rows = live_rows.select(*_KEYS, F.col("id").alias("entity_id"), F.posexplode(column).alias("ord", "_h"))
    return rows.select(
        *_KEYS,
        "entity_id",
        "ord",
        "_h.type",
        _instant("_h.startTime", "start_time"),
        _instant("_h.endTime", "end_time"),
    )


def showtimes(live_rows: DataFrame) -> DataFrame:
    return _hours(live_rows, "showtimes")


def operating_hours(live_rows: DataFrame) -> DataFrame:
    return _hours(live_rows, "operating_hours")


def dining(live_rows: DataFrame) -> DataFrame:
    rows = live_rows.select(*_KEYS, F.col("id").alias("entity_id"), F.posexplode("dining").alias("ord", "_a"))
    return rows.select(
        *_KEYS,
        "entity_id",
        "ord",
        _double("_a.partySize", "party_size"),
        _double("_a.waitTime", "wait_time"),
    )


def _entry_columns() -> list[Column]:
    """Typed columns of the entry exploded as `_e`."""
    return [
        F.col("_e.date"),
        F.col("_e.type"),
        _instant("_e.openingTime", "opening_time"),
        _instant("_e.closingTime", "closing_time"),
        F.col("_e.purchases"),
    ]


def schedule(documents: DataFrame) -> DataFrame:
    """Schedule entries of the document's own entity; `year` and `month` name the page, if any."""
    rows = documents.select(
        *_KEYS, "entity_id", "year", "month", F.posexplode("doc.schedule").alias("ord", "_e")
    )
    return rows.select(*_KEYS, "entity_id", "year", "month", "ord", *_entry_columns())


def destination_schedule(documents: DataFrame) -> DataFrame:
    """Entries of a destination and of the parks listed below it, each with the owner it belongs to.

    Both levels come out of one scan: the document's own schedule and those of its parks form one list.
    """
    doc = F.col("doc")

    def owned(owner: Column, entries: Column) -> Column:
        return F.struct(owner.alias("owner_id"), entries.alias("entries"))

    parks = F.coalesce(
        F.transform(doc["parks"], lambda p: owned(p["id"], p["schedule"])), F.array()
    )
    owners = F.concat(F.array(owned(doc["id"], doc["schedule"])), parks)
    per_owner = documents.select(
        *_KEYS, doc["id"].alias("root_id"), F.posexplode(owners).alias("owner_ord", "_o")
    )
    rows = per_owner.select(
        *_KEYS, "root_id", "owner_ord", "_o.owner_id", F.posexplode("_o.entries").alias("ord", "_e")
    )
    return rows.select(
        *_KEYS, "root_id", "owner_ord", "owner_id", "ord", *_entry_columns()
    )


def nested_schedule(owners: DataFrame) -> DataFrame:
    """Entries of a destination and of all parks below it, at any depth (of `validate.nested_schedules`).

    `owner_place` is the way to the owner: positions in `parks`, none for the document itself.
    """
    rows = owners.select(
        *_KEYS, "root_id", "owner_place", F.col("record.id").alias("owner_id"), F.posexplode("record.schedule").alias("ord", "_e")
    )
    return rows.select(*_KEYS, "root_id", "owner_place", "owner_id", "ord", *_entry_columns())


def purchases(schedule_rows: DataFrame) -> DataFrame:
    """What can be bought for each schedule entry."""
    rows = schedule_rows.select(
        *_KEYS,
        "entity_id",
        "date",
        F.col("ord").alias("entry_ord"),
        F.posexplode("purchases").alias("ord", "_p"),
    )
    return rows.select(
        *_KEYS,
        "entity_id",
        "date",
        "entry_ord",
        "ord",
        "_p.type",
        F.col("_p.id").alias("purchase_id"),
        F.col("_p.name").alias("purchase_name"),
        F.expr(_price("_p.price")).alias("price"),
        F.expr(lax_boolean("_p.available")).alias("available"),
    )
