"""Document checks: a document that breaks any rule is rejected whole, and the reject says why.

Rules
  VAL1  the body is a JSON object, served as JSON
  VAL2  required fields are present
  VAL3  closed domains hold
  VAL4  instants carry an offset
  VAL6  numbers are numbers, numeric text included
  VAL7  a tag value is text, number or object
  NEST  schedules repeat below `parks` at most once, in the typed form; `schedule_levels` reads any depth
  BOOL  flags are booleans
Queue fields are nullable by design: a null wait, state or group never rejects anything.

A check is SQL text over one record; checks on list elements become `exists` lambdas.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelake import schemas as S
from queuelake.functions.numbers import lax_boolean, lax_double
from queuelake.functions.times import no_instant
from queuelake.session import stored
from queuelake.sources.bronze import decode, of_kind

_AS_JSON = "coalesce(contains(content_type, 'application/json'), false)"


class Check(NamedTuple):
    """`broken` gives, for the name of a record, SQL that is true when the record breaks the rule. A check on the elements
    of a list names the `array`, and the check `inside` that one of them has to break (none: it is null)."""

    rule: str
    field: str
    broken: Callable[[str], str]
    array: str = ""
    inside: Check | None = None


def _required(*fields: str) -> list[Check]:
    return [Check("VAL2", f, lambda r, f=f: f"{r}.{f} IS NULL") for f in fields]


def _domain(allowed: tuple[str, ...], *fields: str) -> list[Check]:
    members = ", ".join(f"'{a}'" for a in allowed)
    return [
        Check("VAL3", f, lambda r, f=f: f"coalesce({r}.{f} NOT IN ({members}), false)") for f in fields
    ]


def _castable(rule: str, cast: Callable[[str], str], *fields: str) -> list[Check]:
    return [
        Check(rule, f, lambda r, f=f: f"({r}.{f} IS NOT NULL AND ({cast(f'{r}.{f}')}) IS NULL)")
        for f in fields
    ]


def _instants(*fields: str) -> list[Check]:
    return [Check("VAL4", f, lambda r, f=f: no_instant(f"{r}.{f}")) for f in fields]


def _numbers(*fields: str) -> list[Check]:
    return _castable("VAL6", lax_double, *fields)


def _price(price: str) -> list[Check]:
    """A price may be missing, but one that is there needs an amount and a currency."""
    needed = [
        Check(
            "VAL2",
            f"{price}.{part}",
            lambda r, part=part: f"({r}.{price} IS NOT NULL AND {r}.{price}.{part} IS NULL)",
        )
        for part in ("amount", "currency")
    ]
    return needed + _numbers(f"{price}.amount")


def _some(array: str, predicate: Callable[[str], str]) -> str:
    """Does the predicate hold for any element? Never null; each nesting level names its own element."""
    outer = re.match(r"e(\d+)\b", array)
    element = f"e{int(outer[1]) + 1}" if outer else "e0"
    return f"coalesce(exists({array}, {element} -> {predicate(element)}), false)"


def _each(array: str, checks: list[Check]) -> list[Check]:
    """Lift element checks to the record that holds the array; a missing array breaks nothing."""

    def lift(c: Check) -> Check:
        present = _present(c.broken)
        return Check(c.rule, f"{array}.{c.field}", lambda r: _some(f"{r}.{array}", present), array, c)

    lifted = [lift(c) for c in checks]
    return [Check("VAL2", array, lambda r: _some(f"{r}.{array}", _is_null), array), *lifted]


def _present(broken: Callable[[str], str]) -> Callable[[str], str]:
    """A null element is reported as such, not once more for every field it lacks."""
    return lambda element: f"({element} IS NOT NULL AND {broken(element)})"


def _is_null(record: str) -> str:
    return f"{record} IS NULL"


def _any_broken(checks: list[Check], record: str) -> str:
    """Does the record break any of the checks? One pass over each of its lists tries all checks of its elements."""
    lists: dict[str, list[Check]] = {}
    for c in checks:
        if c.array:
            lists.setdefault(c.array, []).extend([c.inside] if c.inside else [])
    found = [c.broken(record) for c in checks if not c.array]
    found += [_some(f"{record}.{array}", _element_broken(inside)) for array, inside in lists.items()]
    return " OR ".join(found) or "false"


_LOCATION = _numbers("location.latitude", "location.longitude")
_ROOT = _domain(S.ENTITY_TYPES, "entityType")
_HOURS = _required("type") + _instants("startTime", "endTime")
_RETURN = ("queue.RETURN_TIME", "queue.PAID_RETURN_TIME")
_BOARDING = "queue.BOARDING_GROUP"

_LIVE_ENTRY = (
    _required("id", "name", "entityType", "lastUpdated")
    + _domain(S.ENTITY_TYPES, "entityType")
    + _domain(S.LIVE_STATUSES, "status")
    + _domain(S.RETURN_TIME_STATES, *[f"{q}.state" for q in _RETURN])
    + _domain(S.BOARDING_GROUP_STATES, f"{_BOARDING}.allocationStatus")
    + _instants("lastUpdated", f"{_BOARDING}.nextAllocationTime")
    + _instants(*[f"{q}.{t}" for q in _RETURN for t in ("returnStart", "returnEnd")])
    + _numbers(*[f"queue.{q}.waitTime" for q in S.WAIT_VARIANTS])
    + _numbers(*[f"{_BOARDING}.{g}" for g in ("currentGroupStart", "currentGroupEnd", "estimatedWait")])
    + _price("queue.PAID_RETURN_TIME.price")
    + _each("showtimes", _HOURS)
    + _each("operatingHours", _HOURS)
    + _each("diningAvailability", _numbers("partySize", "waitTime"))
)
_CHILD = _required("id", "name", "entityType") + _domain(S.ENTITY_TYPES, "entityType") + _LOCATION
_PURCHASE = (
    _domain(S.PURCHASE_TYPES, "type") + _price("price") + _castable("BOOL", lax_boolean, "available")
)
_ENTRY = (
    _required("date", "openingTime", "closingTime", "type")
    + _domain(S.SCHEDULE_TYPES, "type")
    + _instants("openingTime", "closingTime")
    + _each("purchases", _PURCHASE)
)
# A tag value may be text, a number or an object; a list is the one JSON kind it cannot be.
_TAG = _required("tag", "tagName") + [
    Check("VAL7", "value", lambda r: f"coalesce(schema_of_variant({r}.value) LIKE 'ARRAY%', false)")
]
_TOO_DEEP = Check("NEST", "parks", lambda r: f"coalesce({r}.parks <> '[]', false)")

CHECKS: dict[str, list[Check]] = {
    "destinations": _each("destinations", _each("parks", [])),
    "entity": _required("id", "name", "entityType", "timezone") + _ROOT + _LOCATION + _each("tags", _TAG),
    "children": _ROOT + _each("children", _CHILD),
    "live": _ROOT + _each("liveData", _LIVE_ENTRY),
    "schedule": _ROOT
    + _each("schedule", _ENTRY)
    + _each("parks", [*_ROOT, _TOO_DEEP, *_each("schedule", _ENTRY)]),
}
# The same checks, those on the elements of a list apart, so that the faulty elements can be dropped.
_ON_DOCUMENT: dict[str, list[Check]] = {
    "destinations": [],
    "entity": _required("id", "name", "entityType", "timezone") + _ROOT + _LOCATION,
    "children": _ROOT,
    "live": _ROOT,
    "schedule": _ROOT,
}
_ON_ELEMENTS: dict[str, dict[str, list[Check]]] = {
    "destinations": {"destinations": _each("parks", [])},
    "entity": {"tags": _TAG},
    "children": {"children": _CHILD},
    "live": {"liveData": _LIVE_ENTRY},
    "schedule": {"schedule": _ENTRY, "parks": [*_ROOT, _TOO_DEEP, *_each("schedule", _ENTRY)]},
}


def _element_broken(checks: list[Check]) -> Callable[[str], str]:
    return lambda element: f"({element} IS NULL OR {_any_broken(checks, element)})"


def check(bronze: DataFrame, kind: str) -> DataFrame:
    """Decoded responses of one kind with `valid`: does the document keep every rule?"""
    broken = ["corrupt", f"NOT {_AS_JSON}", _any_broken(_ON_DOCUMENT[kind], "doc")]
    for array, checks in _ON_ELEMENTS[kind].items():
        broken.append(_some(f"doc.{array}", _element_broken(checks)))
    decoded = decode(of_kind(bronze, kind), kind)
    return decoded.withColumn("valid", F.expr(f"NOT ({' OR '.join(broken)})"))


def documents(bronze: DataFrame, kind: str, per_element: bool = False) -> DataFrame:
    """Valid documents of one kind.

    `per_element=True` keeps a document whose only faults are in list elements and drops just those
    elements.
    """
    if not per_element:
        return accepted(check(bronze, kind))
    decoded = decode(of_kind(bronze, kind), kind).where(f"NOT corrupt AND {_AS_JSON}")
    decoded = decoded.where(f"NOT ({_any_broken(_ON_DOCUMENT[kind], 'doc')})")
    doc = F.col("doc")
    for array, checks in _ON_ELEMENTS[kind].items():
        kept = F.expr(f"filter(doc.{array}, e0 -> NOT {_element_broken(checks)('e0')})")
        doc = doc.withField(array, kept)
    return decoded.withColumn("doc", doc).drop("corrupt")


class ScheduleLevels(NamedTuple):
    """Schedule documents of any depth, level by level, all of it stored.

    documents: every response with `doc` (its own level), `corrupt`, `valid` and its number `doc_key`
    late: those of the documents that have parks, so that only the levels below told whether they are valid
    owners: of valid documents, the document and every park below it as (`owner_place`, `record`); the place is the
        positions in `parks` from the top, none for the document itself
    rejects: rule and field of every broken rule; `parks` is repeated once a level
    """

    documents: DataFrame
    late: DataFrame
    owners: DataFrame
    rejects: DataFrame


_LIST_OF_PARKS = "schema_of_variant(record.parks) LIKE 'ARRAY%'"
_LEVEL = [
    *_ROOT,
    *_each("schedule", _ENTRY),
    Check("VAL2", "parks", lambda r: f"coalesce(schema_of_variant({r}.parks) NOT LIKE 'ARRAY%' AND schema_of_variant({r}.parks) <> 'VOID', false)"),
]


def _broken_rules(checks: list[Check], record: str, prefix: str = "") -> str:
    """SQL list of the broken rules of a record. Rules are tried one by one only where any is broken at all."""
    found = [f"CASE WHEN {c.broken(record)} THEN named_struct('rule', '{c.rule}', 'field', '{prefix}{c.field}') END" for c in checks]
    return f"filter(CASE WHEN {_any_broken(checks, record)} THEN array({', '.join(found)}) ELSE array() END, v -> v IS NOT NULL)"


def schedule_levels(bronze: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> ScheduleLevels:
    """Read schedule documents whose `parks` repeat the document to any depth.

    A body is parsed once, its `parks` as a variant. Each level is made from the parks of the level above that have
    any, one row per park, and stored; a document without parks takes no part in further rounds, and none is parsed
    again. One faulty record at any depth rejects its document. `keep` stores the parsed documents and reads them back;
    `valid` is null there for those that have parks.
    """
    keys = ("seq", "path", "fetched_at")
    decoded = decode(of_kind(bronze, "schedule"), "schedule", S.SCHEDULE_LEVEL)
    own = F.expr(_broken_rules(_LEVEL, "doc"))
    unreadable = "CASE WHEN corrupt THEN array(named_struct('rule', 'VAL1', 'field', 'body'))" + (
        f" WHEN NOT {_AS_JSON} THEN array(named_struct('rule', 'VAL1', 'field', 'content_type')) END"
    )
    top = decoded.select(F.monotonically_increasing_id().alias("doc_key"), "*").withColumn("broken", F.coalesce(F.expr(unreadable), own))
    top = top.withColumn("valid", F.expr("CASE WHEN size(broken) > 0 THEN false WHEN schema_of_variant(doc.parks) LIKE 'ARRAY%' THEN NULL ELSE true END"))
    top = stored(top, "schedule-documents") if keep is None else keep(top)
    own_level = (F.col("doc.id").alias("root_id"), F.array().cast("array<int>").alias("owner_place"), F.col("doc").alias("record"))
    with_parks = top.where("valid IS NULL")
    owners = with_parks.select("doc_key", *keys, *own_level, "broken")
    depth, level = 0, owners
    while True:
        open_ = level.where(_LIST_OF_PARKS)
        below = open_.select(
            "doc_key", *keys, "root_id", "owner_place",
            F.posexplode(F.try_variant_get("record.parks", "$", "array<variant>")).alias("at", "park"),
        )
        # The record sits inside a generator, so that filters on it do not read the variant again.
        record = F.try_variant_get("park", "$", S.SCHEDULE_LEVEL.simpleString())
        below = below.select(
            "doc_key", *keys, "root_id", F.concat("owner_place", F.array("at")).alias("owner_place"), F.explode(F.array(record)).alias("record")
        )
        depth += 1
        prefix = "parks." * depth
        missing = f"array(named_struct('rule', 'VAL2', 'field', '{prefix[:-1]}'))"
        broken = f"CASE WHEN record IS NULL THEN {missing} ELSE {_broken_rules(_LEVEL, 'record', prefix)} END"
        level = stored(below.withColumn("broken", F.expr(broken)), "schedule-level")
        if level.isEmpty():
            break
        owners = owners.unionByName(level)
        level = level.where("size(broken) = 0")
    below_top = owners.where("size(broken) > 0").select("doc_key", F.explode("broken").alias("v"))
    faulty = stored(below_top.unionByName(top.where("NOT valid").select("doc_key", F.explode("broken").alias("v"))), "schedule-faults")
    keys_of_faulty = faulty.select("doc_key").distinct()
    marked = with_parks.drop("broken").join(keys_of_faulty.withColumn("faulty", F.lit(True)), "doc_key", "left")
    late = marked.withColumn("valid", F.col("faulty").isNull()).drop("faulty")
    told = faulty.select("doc_key", "v.rule", "v.field").distinct().join(top.where("NOT coalesce(valid, false)").select("doc_key", *keys, "body"), "doc_key")
    return ScheduleLevels(
        top.where("valid IS NOT NULL").drop("broken").unionByName(late),
        late,
        top.where("valid").select("doc_key", *keys, *own_level).unionByName(owners.drop("broken").join(keys_of_faulty, "doc_key", "left_anti")),
        told.select(*keys, "body", "rule", "field"),
    )


def nested_schedules(bronze: DataFrame) -> DataFrame:
    """Owners of the valid schedule documents of any depth (see `schedule_levels`)."""
    return schedule_levels(bronze).owners


def _violations(kind: str) -> Column:
    """Every `(rule, field)` a document breaks. A body that does not parse breaks only VAL1."""

    def named(broken: str, rule: str, field: str) -> str:
        return f"CASE WHEN {broken} THEN named_struct('rule', '{rule}', 'field', '{field}') END"

    unreadable = [named("corrupt", "VAL1", "body"), named("NOT corrupt", "VAL1", "content_type")]
    readable = [named(c.broken("doc"), c.rule, c.field) for c in CHECKS[kind]]
    return F.expr(
        f"CASE WHEN corrupt OR NOT {_AS_JSON} THEN array({', '.join(unreadable)})"
        f" ELSE array({', '.join(readable)}) END"
    )


def accepted(checked: DataFrame) -> DataFrame:
    """Valid documents among checked ones (`check`, or a table stored by `sinks.write_checked`)."""
    return checked.where("valid").drop("valid", "corrupt")


def rejected(checked: DataFrame, kind: str) -> DataFrame:
    """One row per broken rule and field of checked documents, with the response kept for repair."""
    faulty = checked.where(~F.col("valid"))
    return (
        faulty.select("seq", "path", "fetched_at", "body", F.explode(_violations(kind)).alias("_v"))
        .where(F.col("_v").isNotNull())
        .select("seq", "path", "fetched_at", "body", "_v.rule", "_v.field")
    )


def rejects(bronze: DataFrame, kind: str) -> DataFrame:
    """What is wrong with the responses of one kind."""
    return rejected(check(bronze, kind), kind)


def split(bronze: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Valid documents and rejects; write the lake with `sinks.write_checked` to decode only once."""
    return documents(bronze, kind), rejects(bronze, kind)
