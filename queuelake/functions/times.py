"""Date texts, instants and calendar months.

All functions expect the session zone to be UTC (see `queuelake.session.prepare`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"^\d{4}-\d{2}-\d{2}"
_CLOCK = r"[T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?"
_OFFSET = r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)"
_AWARE = f"{_DATE}{_CLOCK}{_OFFSET}$"
_NAIVE = f"{_DATE}({_CLOCK})?$"
# What a cast reads without help: every part is there, in its usual form.
_WHOLE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
# What a cast cannot fail on either: of that form, with a day that every month has and an offset that clocks have.
_SURE = (
    r"^[1-9]\d{3}-(0[1-9]|1[0-2])-(0[1-9]|1\d|2[0-8])T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,6})?"
    r"(Z|[+-](0\d|1[0-7]):[0-5]\d)\z"
)
# Epoch numbers, as written or in the exponent form a parsed JSON number takes.
_EPOCH = r"^[+-]?(\d+(\.\d+)?|\d(\.\d+)?E\d{1,2})$"
# The first and the last second of the years 1 to 9999.
_FIRST_SECOND, _LAST_SECOND = "-62135596800D", "253402300799.999999D"
# A zone's name; not an offset from UTC; and, fixed values, the short names that the JVM alone takes for zones.
_ZONE = r"^[A-Za-z][A-Za-z0-9_+-]+(/[A-Za-z0-9_+-]+)*$"
_FIXED_OFFSET = r"^(UTC|UT|GMT)[+-]0*[1-9]"
_NOT_ZONES = (
    "ACT", "AET", "AGT", "ART", "AST", "BET", "BST", "CAT", "CNT", "CST", "CTT", "EAT", "ECT", "IET", "IST", "JST",
    "MIT", "NET", "NST", "PLT", "PNT", "PRT", "PST", "SST", "VST",
)
# Numbers above this are epoch milliseconds, up to it epoch seconds.
_MILLIS_ABOVE = "2e10D"


def _with_seconds(text: str) -> str:
    """Spark's cast wants minutes and seconds in front of an offset."""
    minutes = rf"regexp_replace({text}, r'^(.{{10}}[T ]\d{{2}})(?=Z|[+-]|$)', '$1:00')"
    return rf"regexp_replace({minutes}, r'^(.{{10}}[T ]\d{{2}}:\d{{2}})(?=Z|[+-]|$)', '$1:00')"


def aware_instant(text: str) -> str:
    """SQL for the instant of a payload text that names its own offset, or of an epoch number.

    Naive, date-only or bad text gives null. Kept small, since it is repeated for every instant field. Text in the form
    that APIs write is cast as it is; only other forms go through the replacements, which cost more than the cast.
    """
    number = f"try_cast({text} AS DOUBLE)"
    seconds = f"({number} / CASE WHEN abs({number}) > {_MILLIS_ABOVE} THEN 1000 ELSE 1 END)"
    # Behind the date, `t`, `_` and `z` stand for their upper-case or blank forms.
    clock = rf"concat(left({text}, 10), regexp_replace(translate(substring({text}, 11), 't_z', 'T Z'), r'([+-]\d{{2}})$', '$1:00'))"
    padded = f"regexp_replace({clock}, r'^(.{{16}})(?=Z|[+-])', '$1:00')"
    aware = rf"(?i)^\d{{4}}-\d{{2}}-\d{{2}}[T _]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?{_OFFSET}$"
    return (
        f"CASE WHEN {text} RLIKE r'{_WHOLE}' THEN try_cast({text} AS TIMESTAMP)"
        f" WHEN {text} RLIKE r'{aware}' THEN try_cast({padded} AS TIMESTAMP)"
        f" WHEN {text} RLIKE r'{_EPOCH}' AND {seconds} BETWEEN {_FIRST_SECOND} AND {_LAST_SECOND}"
        f" THEN timestamp_seconds({seconds}) END"
    )


def no_instant(text: str) -> str:
    """SQL that is true when a payload text is there and `aware_instant` makes nothing of it. A look at the text settles
    most; only where it does not is the instant worked out."""
    return f"({text} IS NOT NULL AND NOT {text} RLIKE r'{_SURE}' AND ({aware_instant(text)}) IS NULL)"


def _plain(text: str) -> str:
    """Compact and week dates, compact clocks, comma fractions and hour-only offsets in extended form."""
    week = rf"regexp_extract({text}, r'^(\d{{4}})-?W(\d{{2}})(?:-?(\d))?(.*)$', %d)"
    monday = f"date_trunc('week', make_date(cast({week % 1} AS INT), 1, 4))"
    days = f"7 * (cast({week % 2} AS INT) - 1) + cast(coalesce(nullif({week % 3}, ''), '1') AS INT) - 1"
    in_week = rf"{text} RLIKE r'^\d{{4}}-?W\d{{2}}(-?[1-7])?([T ].*)?$'"
    dated = f"CASE WHEN {in_week} THEN concat(cast(date_add(cast({monday} AS DATE), {days}) AS STRING), {week % 4}) ELSE {text} END"
    full = rf"regexp_replace({dated}, r'^(\d{{4}})(\d{{2}})(\d{{2}})(?=$|[T ])', '$1-$2-$3')"
    full = rf"regexp_replace({full}, r'^(.{{10}}[T ]\d{{2}})(\d{{2}})(\d{{2}})?(?=$|[.,Z+-])', '$1:$2:$3')"
    full = rf"regexp_replace({full}, r'^(.{{10}}[T ]\d{{2}}:\d{{2}}):(?=$|[Z+-])', '$1')"
    full = rf"regexp_replace({full}, r',(?=\d)', '.')"
    return rf"regexp_replace({full}, r'^(.{{10}}[T ].*[+-]\d{{2}})$', '$1:00')"


def parse_api_datetime(text: str, timezone: str, strict: bool = False) -> Column:
    """Instant of an API date text: its own offset when it has one, else local time in `timezone`.

    Both arguments are column names or SQL text. Gaps and folds of daylight saving resolve to the offset
    in force before the change. Bad text and unknown zones give null, or fail the job when `strict`. Zones
    are looked up by the JVM, so that every machine of a cluster knows the same ones.
    """
    plain = _plain(text)
    short = ", ".join(f"'{z}'" for z in _NOT_ZONES)
    named = f"{timezone} RLIKE r'{_ZONE}' AND NOT {timezone} RLIKE r'{_FIXED_OFFSET}' AND {timezone} NOT IN ({short})"
    clock = f"CAST(try_cast({_with_seconds(plain)} AS TIMESTAMP_NTZ) AS STRING)"
    local = f"WHEN {plain} RLIKE r'{_NAIVE}' THEN CASE WHEN {named} THEN try_cast(concat({clock}, ' ', {timezone}) AS TIMESTAMP) END"
    aware = f"WHEN {plain} RLIKE r'{_AWARE}' THEN try_cast({_with_seconds(plain)} AS TIMESTAMP)"
    instant = f"CASE {aware} {local} END"
    if strict:
        complaint = f"CAST(raise_error(concat('invalid date: ', {text})) AS TIMESTAMP)"
        instant = f"CASE WHEN {text} IS NOT NULL THEN coalesce({instant}, {complaint}) END"
    return F.expr(instant)


def months_between_inclusive(start: Column, end: Column) -> Column:
    """Array with the first day of every calendar month touched; empty when `end` is before `start`."""
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("INTERVAL 1 MONTH"))
    return F.when(end >= start, months).otherwise(F.array().cast("array<date>"))
