"""Closed domains and explicit payload schemas.

Payloads land with every scalar as text: a cast that fails can then be told apart from a value that
was never sent, and naive timestamps never pick up the session zone on the way in. Typed columns are
made when rows are flattened.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The closed domains of the data source.
ENTITY_TYPES = ("DESTINATION", "PARK", "ATTRACTION", "RESTAURANT", "HOTEL", "SHOW")
LIVE_STATUSES = ("OPERATING", "DOWN", "CLOSED", "REFURBISHMENT")
RETURN_TIME_STATES = ("AVAILABLE", "TEMP_FULL", "FINISHED")
BOARDING_GROUP_STATES = ("AVAILABLE", "PAUSED", "CLOSED")
PURCHASE_TYPES = ("ADMISSION", "PACKAGE", "ATTRACTION")
SCHEDULE_TYPES = ("OPERATING", "TICKETED_EVENT", "PRIVATE_EVENT", "EXTRA_HOURS", "INFO")
# Queue variants, in output order.
QUEUE_VARIANTS = (
    "STANDBY",
    "SINGLE_RIDER",
    "RETURN_TIME",
    "PAID_RETURN_TIME",
    "BOARDING_GROUP",
    "PAID_STANDBY",
)
# Variants that carry nothing but a wait.
WAIT_VARIANTS = ("STANDBY", "SINGLE_RIDER", "PAID_STANDBY")

CORRUPT = "_corrupt"

BRONZE = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)


def _record(*texts: str, **nested: T.DataType) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in texts]
    fields += [T.StructField(name, kind) for name, kind in nested.items()]
    return T.StructType(fields)


_PRICE = _record("amount", "currency", "formatted")
_LOCATION = _record("latitude", "longitude")
_WAIT = _record("waitTime")
_QUEUE = _record(
    STANDBY=_WAIT,
    SINGLE_RIDER=_WAIT,
    RETURN_TIME=_record("state", "returnStart", "returnEnd"),
    PAID_RETURN_TIME=_record("state", "returnStart", "returnEnd", price=_PRICE),
    BOARDING_GROUP=_record(
        "allocationStatus", "currentGroupStart", "currentGroupEnd", "nextAllocationTime", "estimatedWait"
    ),
    PAID_STANDBY=_WAIT,
)
_HOURS = T.ArrayType(_record("type", "startTime", "endTime"))
_LIVE_ENTRY = _record(
    "id",
    "name",
    "entityType",
    "status",
    "lastUpdated",
    queue=_QUEUE,
    showtimes=_HOURS,
    operatingHours=_HOURS,
    diningAvailability=T.ArrayType(_record("partySize", "waitTime")),
)
_CHILD = _record("id", "name", "entityType", "externalId", "parentId", location=_LOCATION)
_ENTRY = _record(
    "date",
    "openingTime",
    "closingTime",
    "type",
    purchases=T.ArrayType(_record("type", "id", "name", "available", price=_PRICE)),
)
_HEADER = ("id", "name", "entityType", "timezone")

# A schedule document may repeat itself below `parks`. In the typed landing form two levels are unrolled and the
# third stays text, for which `validate.documents` rejects the document.
NESTED_SCHEDULE = _record(*_HEADER, "parks", schedule=T.ArrayType(_ENTRY))
# One level of a schedule of any depth: what is below stays a variant until its own level is made.
SCHEDULE_LEVEL = _record(*_HEADER, parks=T.VariantType(), schedule=T.ArrayType(_ENTRY))

LANDING: dict[str, T.StructType] = {
    "destinations": _record(
        destinations=T.ArrayType(
            _record("id", "name", "slug", "externalId", parks=T.ArrayType(_record("id", "name")))
        )
    ),
    "entity": _record(
        "id",
        "name",
        "entityType",
        "parentId",
        "destinationId",
        "timezone",
        location=_LOCATION,
        tags=T.ArrayType(_record("tag", "tagName", "id", value=T.VariantType())),
    ),
    "children": _record(*_HEADER, children=T.ArrayType(_CHILD)),
    "live": _record(*_HEADER, liveData=T.ArrayType(_LIVE_ENTRY)),
    "schedule": _record(
        *_HEADER, schedule=T.ArrayType(_ENTRY), parks=T.ArrayType(NESTED_SCHEDULE)
    ),
}
