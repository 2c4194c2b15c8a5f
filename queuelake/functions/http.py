"""Expressions over one recorded response: retry hints, backoff bounds, bodies and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from queuelake.functions.numbers import NUMBER

# Retry rules and message limits.
MAX_RETRIES = 3
BACKOFF_BASE = 0.25
BACKOFF_JITTER = 1.25
BACKOFF_CAP = 5.0
MESSAGE_LIMIT = 300
EXCERPT_LIMIT = 200
TOO_MANY_REQUESTS = 429
SERVER_ERROR = 500
# Dates of mail and HTTP headers, weekday optional: day, month, year, clock and zone; and the form of C's asctime.
_DATE = r"(?i)^(?:[a-z]+,?\s*)?(\d{1,2})[\s-]+([a-z]{3})[a-z]*[\s-]+(\d{2}|\d{4})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s+([a-z]+|[+-]\d{4}))?$"
_ASCTIME = r"(?i)^(?:[a-z]+,?\s+)?([a-z]{3})\s+(\d{1,2})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s+(\d{4})$"
# Hours of the named zones of mail headers; any other name counts as UTC.
_ZONE_HOURS = {
    "AST": -4, "ADT": -3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
}


def header_instant(text: Column) -> Column:
    """Instant of a date header; without a zone, or with `-0000`, it is UTC. Bad dates give null."""
    parts = lambda form, *groups: [F.regexp_extract(text, form, g) for g in groups]
    usual = text.rlike(_DATE)
    common, old = parts(_DATE, 3, 2, 1, 4, 5, 6), parts(_ASCTIME, 6, 1, 2, 3, 4, 5)
    year, month, day, hour, minute, second = (F.when(usual, a).otherwise(b) for a, b in zip(common, old, strict=True))
    century = F.when(F.length(year) == 4, "").when(year > "68", "19").otherwise("20")
    at = F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(month))
    number = F.when(at % 3 == 1, F.lpad(((at + 2) / 3).cast("int").cast("string"), 2, "0"))
    clock = F.concat_ws(":", F.lpad(hour, 2, "0"), minute, F.when(second == "", "00").otherwise(second))
    local = F.concat(century, year, F.lit("-"), number, F.lit("-"), F.lpad(day, 2, "0"), F.lit(" "), clock).try_cast("timestamp")
    zone = F.upper(F.regexp_extract(text, _DATE, 7))
    hours = F.coalesce(*[F.when(zone == name, h * 3600) for name, h in _ZONE_HOURS.items()], F.lit(0))
    offset = F.substring(zone, 2, 2).try_cast("int") * 3600 + F.substring(zone, 4, 2).try_cast("int") * 60
    ahead = F.when(zone.startswith("+"), offset).when(zone.startswith("-"), -offset).otherwise(hours)
    return F.when(usual | text.rlike(_ASCTIME), F.timestamp_micros(F.unix_micros(local) - ahead.cast("bigint") * 1_000_000))


def retry_after_seconds(raw: Column, received_at: Column) -> Column:
    """Seconds to wait: a number, or an HTTP date relative to `received_at`; never below 0, null if neither."""
    number = F.when(raw.rlike(NUMBER), F.trim(raw).try_cast("double"))
    clamped = F.when(F.isnan(number), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), number))
    instant = header_instant(F.trim(raw))
    ahead = (F.unix_micros(instant) - F.unix_micros(received_at.cast("timestamp"))) / 1e6
    return F.when(number.isNotNull(), clamped).when(
        instant.isNotNull(), F.greatest(F.lit(0.0), ahead)
    )


def backoff_low(attempt: Column) -> Column:
    return F.least(F.lit(BACKOFF_CAP), F.lit(BACKOFF_BASE) * F.pow(F.lit(2.0), attempt))


def backoff_high(attempt: Column) -> Column:
    grown = F.lit(BACKOFF_BASE) * F.pow(F.lit(2.0), attempt) * F.lit(BACKOFF_JITTER)
    return F.least(F.lit(BACKOFF_CAP), grown)


def is_json_body(content_type: Column) -> Column:
    return F.coalesce(F.contains(content_type, F.lit("application/json")), F.lit(False))


def error_message(status: Column, reason: Column, content_type: Column, body: Column) -> Column:
    """`status reason`, then the body's `error` member or an excerpt of the body when there is one.

    A JSON body that does not parse counts as absent; JSON bodies without `error` keep their JSON text.
    """
    head = F.concat_ws(" ", status.cast("string"), F.coalesce(reason, F.lit("")))
    parsed = F.try_parse_json(body)
    json = is_json_body(content_type)
    has_error = json & F.coalesce(F.array_contains(F.json_object_keys(body), "error"), F.lit(False))
    error = F.coalesce(F.try_variant_get(parsed, "$.error", "string"), F.lit("None"))
    shown = F.when(json, parsed.cast("string")).otherwise(body)
    excerpt = F.when(
        F.length(shown) > EXCERPT_LIMIT, F.concat(F.left(shown, F.lit(EXCERPT_LIMIT)), F.lit("..."))
    ).otherwise(shown)
    return (
        F.when(has_error, F.left(F.concat(head, F.lit(": "), error), F.lit(MESSAGE_LIMIT)))
        .when(shown.isNull() | (shown == ""), head)
        .otherwise(F.concat(head, F.lit(": "), excerpt))
    )
