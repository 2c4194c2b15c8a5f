"""Decoding, checks and flattening of whole documents."""

import json

import pytest
from pyspark.sql import functions as F

from queuelake.operators import flatten, live
from queuelake.sources import validate

LIVE = "/entity/p1/live"


def entry(**changes):
    base = {
        "id": "mill-7",
        "name": "Old Mill",
        "entityType": "SHOW",
        "status": "DOWN",
        "lastUpdated": "2025-07-03T18:20:00Z",
    }
    return {k: v for k, v in {**base, **changes}.items() if v != "absent"}


def live_doc(*entries):
    return {"id": "p1", "liveData": list(entries)}


def broken_rules(landed, kind, path, *bodies):
    rows = validate.rejects(landed(*[(path, b) for b in bodies]), kind).collect()
    found = {}
    for r in rows:
        found.setdefault(r.seq, set()).add((r.rule, r.field))
    return [found.get(i, set()) for i in range(len(bodies))]


def test_bodies_that_are_no_json_object(landed):
    whole = json.dumps(live_doc(entry()))
    bodies = ["", "nope", "[]", f"[{whole}]", "null", "5", '"text"', whole[:40], whole + " tail", whole * 2, None]
    bodies += ["{'id':'single quotes'}", whole + "}", whole + "]}", whole + ',"x":1', f"{whole},{whole}", whole + ","]
    good = [whole, "  " + whole + "\n", "{}"]
    expected = [{("VAL1", "body")}] * len(bodies) + [set()] * len(good)
    assert broken_rules(landed, "live", LIVE, *bodies, *good) == expected


def test_text_responses_are_no_documents(landed):
    bronze = landed((LIVE, live_doc(entry())), content_type="text/plain")
    assert [r.field for r in validate.rejects(bronze, "live").collect()] == ["content_type"]
    assert validate.documents(bronze, "live").count() == 0


def test_failed_responses_are_not_scanned(landed):
    bronze = landed((LIVE, live_doc(entry())), status=503)
    assert validate.check(bronze, "live").count() == 0


def test_live_rules(landed):
    queue = "liveData.queue"
    cases = [
        (entry(), set()),
        (entry(name=None), {("VAL2", "liveData.name")}),
        (entry(id="absent"), {("VAL2", "liveData.id")}),
        (entry(status=None), set()),
        (entry(status="OPEN"), {("VAL3", "liveData.status")}),
        (entry(entityType="RIDE"), {("VAL3", "liveData.entityType")}),
        (entry(lastUpdated="2026-04-14T12:00:00"), {("VAL4", "liveData.lastUpdated")}),
        (entry(lastUpdated=1700000000), set()),
        (entry(queue={"STANDBY": {"waitTime": "soon"}}), {("VAL6", f"{queue}.STANDBY.waitTime")}),
        (entry(queue={"STANDBY": {"waitTime": "30"}}), set()),
        (entry(queue=5), {("VAL1", "body")}),
        (entry(queue={"RETURN_TIME": {"state": "LATER"}}), {("VAL3", f"{queue}.RETURN_TIME.state")}),
        (
            entry(queue={"PAID_RETURN_TIME": {"price": {"formatted": "$5"}}}),
            {("VAL2", f"{queue}.PAID_RETURN_TIME.price.{f}") for f in ("amount", "currency")},
        ),
        (entry(showtimes=[{"startTime": None}]), {("VAL2", "liveData.showtimes.type")}),
        (entry(operatingHours=[None]), {("VAL2", "liveData.operatingHours")}),
        (entry(id=5), set()),
        (None, {("VAL2", "liveData")}),
    ]
    got = broken_rules(landed, "live", LIVE, *[live_doc(entry(), e) for e, _ in cases])
    assert got == [expected for _, expected in cases]
    bronze = landed(*[(LIVE, live_doc(entry(), e)) for e, _ in cases])
    kept = {r.seq for r in validate.documents(bronze, "live").select("seq").collect()}
    assert kept == {i for i, (_, expected) in enumerate(cases) if not expected}


def test_null_queue_fields_never_reject(landed):
    empty = {
        "STANDBY": {"waitTime": None},
        "SINGLE_RIDER": {},
        "RETURN_TIME": {"state": None, "returnStart": None, "returnEnd": None},
        "PAID_RETURN_TIME": {"state": None, "price": None},
        "BOARDING_GROUP": {"allocationStatus": None, "currentGroupStart": None, "nextAllocationTime": None},
        "PAID_STANDBY": {"waitTime": None},
    }
    rows = flatten.live(validate.documents(landed((LIVE, live_doc(entry(queue=empty)))), "live"))
    assert [r.type for r in live.queue_offers(rows).orderBy("variant_ord").collect()] == list(empty)


def test_per_element_keeps_the_good_ones(landed):
    bronze = landed((LIVE, live_doc(entry(id="a"), entry(id="b", status="OPEN"), entry(id="c"))))
    assert validate.documents(bronze, "live").count() == 0
    kept = flatten.live(validate.documents(bronze, "live", per_element=True)).orderBy("ord")
    assert [r.id for r in kept.collect()] == ["a", "c"]


@pytest.mark.parametrize(
    ("queue", "expected"),
    [
        ("absent", []),
        (None, []),
        ({}, []),
        ({"STANDBY": None}, []),
        ({"STANDBY": {}}, [("STANDBY", None)]),
        ({"STANDBY": {"waitTime": 45.9}}, [("STANDBY", 45.9)]),
        ({"STANDBY": {"waitTime": True}}, [("STANDBY", 1.0)]),
        (
            {v: {"waitTime": 5} for v in ("PAID_STANDBY", "SINGLE_RIDER", "STANDBY")},
            [("STANDBY", 5.0), ("SINGLE_RIDER", 5.0), ("PAID_STANDBY", 5.0)],
        ),
    ],
)
def test_unpivot(landed, queue, expected):
    rows = flatten.live(validate.documents(landed((LIVE, live_doc(entry(queue=queue)))), "live"))
    offers = live.queue_offers(rows).orderBy("variant_ord")
    assert [(r.type, r.wait_time) for r in offers.collect()] == expected


def test_offers_carry_their_variant_fields(landed):
    queue = {
        "PAID_RETURN_TIME": {
            "state": "AVAILABLE",
            "returnStart": "2026-04-15T14:30:00-04:00",
            "price": {"amount": 15, "currency": "USD", "formatted": "$15.00"},
        },
        "BOARDING_GROUP": {"allocationStatus": "PAUSED", "currentGroupStart": 38, "currentGroupEnd": 41, "estimatedWait": 25},
    }
    rows = flatten.live(validate.documents(landed((LIVE, live_doc(entry(queue=queue)))), "live"))
    paid, group = live.queue_offers(rows).orderBy("variant_ord").collect()
    assert (paid.state, paid.price.asDict()) == ("AVAILABLE", {"amount": 15.0, "currency": "USD", "formatted": "$15.00"})
    assert paid.return_start.isoformat().startswith("2026-04-15T") and paid.return_end is None
    assert (group.allocation_status, group.group_start, group.group_end, group.estimated_wait) == ("PAUSED", 38.0, 41.0, 25.0)
    wide = live.queue_wide(rows).collect()[0]
    assert (wide.paid_return_price, wide.has_boarding_group, wide.has_return_time) == ("$15.00", True, False)


def test_price_label_only_replaces_a_missing_price(landed):
    def paid(price):
        return entry(queue={"PAID_RETURN_TIME": {"price": price}})

    doc = live_doc(paid(None), paid({"amount": 1, "currency": "USD"}), paid({"amount": 1, "currency": "USD", "formatted": "$1"}))
    rows = flatten.live(validate.documents(landed((LIVE, doc)), "live"))
    labels = [r.paid_return_price for r in live.queue_wide(rows).orderBy("ord").collect()]
    assert labels == ["?", None, "$1"]


@pytest.mark.parametrize("body", [{"id": "p1"}, {"id": "p1", "children": None}, {"id": "p1", "children": []}])
def test_missing_null_and_empty_lists_are_equal(landed, body):
    documents = validate.documents(landed(("/entity/p1/children", body)), "children")
    assert documents.count() == 1
    assert flatten.descendants(documents).count() == 0


def test_walk_keeps_payload_order_and_leaves_out_the_root(landed):
    def child(i, **more):
        return {"id": i, "name": i, "entityType": "SHOW", "slug": "ignored", **more}

    body = {"id": "p1", "children": [child("z"), child("a", location={"latitude": 1.5}), child("m", location={})]}
    rows = flatten.descendants(validate.documents(landed(("/entity/p1/children", body)), "children"))
    got = rows.orderBy("ord").collect()
    assert [(r.ord, r.id, r.latitude, r.longitude) for r in got] == [(0, "z", None, None), (1, "a", 1.5, None), (2, "m", None, None)]
    assert {r.root_id for r in got} == {"p1"}


def test_directory_and_its_parks(landed):
    body = {"destinations": [{"id": "b", "name": "B", "slug": "b", "parks": [{"id": "p2", "name": "P2"}, {"id": "p1"}]}, {"id": "a"}]}
    rows = flatten.destinations(validate.documents(landed(("/destinations", body)), "destinations"))
    assert [(r.ord, r.id) for r in rows.orderBy("ord").collect()] == [(0, "b"), (1, "a")]
    parks = flatten.destination_parks(rows).orderBy("park_ord").collect()
    assert [(r.destination_id, r.park_id, r.park_name) for r in parks] == [("b", "p2", "P2"), ("b", "p1", None)]


def schedule_entry(date, **more):
    return {"date": date, "type": "OPERATING", "openingTime": f"{date}T09:00:00+00:00", "closingTime": f"{date}T21:00:00+00:00", **more}


def test_destination_schedule_has_both_levels(landed):
    body = {
        "id": "d",
        "schedule": [schedule_entry("2026-01-01")],
        "parks": [
            {"id": "p1", "schedule": [schedule_entry("2026-01-02"), schedule_entry("2026-01-03")]},
            {"id": "p2", "schedule": None, "parks": []},
        ],
    }
    docs = validate.documents(landed(("/entity/d/schedule", body)), "schedule")
    rows = flatten.destination_schedule(docs).orderBy("owner_ord", "ord").collect()
    assert [(r.owner_id, r.date) for r in rows] == [("d", "2026-01-01"), ("p1", "2026-01-02"), ("p1", "2026-01-03")]


def test_schedules_nest_to_any_depth(landed):
    def park(name, day, *parks, **more):
        return {"id": name, "schedule": [schedule_entry(day, **more)], "parks": list(parks)}

    deep = park("d", "2026-01-01", park("p", "2026-01-02", park("q", "2026-01-03", park("r", "2026-01-04")), park("s", "2026-01-05")))
    bad = park("d", "2026-01-01", park("p", "2026-01-02", park("q", "2026-01-03", park("r", "2026-01-04", type="CLOSED"))))
    no_list = {"id": "e", "schedule": [schedule_entry("2026-01-01")], "parks": [{"id": "p", "parks": [{"id": "q", "parks": {"id": "r"}}]}]}
    flat = {"id": "f", "schedule": [schedule_entry("2026-02-01")]}
    found = landed(*[("/entity/d/schedule", b) for b in (deep, bad, no_list, flat)])
    rows = flatten.nested_schedule(validate.nested_schedules(found)).collect()
    assert sorted((r.seq, r.owner_place, r.owner_id, r.date) for r in rows) == [
        (0, [], "d", "2026-01-01"),
        (0, [0], "p", "2026-01-02"),
        (0, [0, 0], "q", "2026-01-03"),
        (0, [0, 0, 0], "r", "2026-01-04"),
        (0, [0, 1], "s", "2026-01-05"),
        (3, [], "f", "2026-02-01"),
    ]


def test_schedule_rules(landed):
    path = "/entity/d/schedule/2026/01"
    deep = {"id": "d", "parks": [{"id": "p", "parks": [{"id": "q"}]}]}
    sold = [{"price": {"amount": "x", "currency": "USD"}, "available": "perhaps", "type": "RAFFLE"}]
    bodies = [
        {"schedule": [schedule_entry("2026-01-01", purchases=[{"available": "true"}])]},
        deep,
        {"schedule": [schedule_entry("2026-01-01", purchases=sold)]},
        {"parks": [{"schedule": [schedule_entry("2026-01-01", type="CLOSED")]}]},
    ]
    assert broken_rules(landed, "schedule", path, *bodies) == [
        set(),
        {("NEST", "parks.parks")},
        {
            ("VAL6", "schedule.purchases.price.amount"),
            ("BOOL", "schedule.purchases.available"),
            ("VAL3", "schedule.purchases.type"),
        },
        {("VAL3", "parks.schedule.type")},
    ]


def test_purchases(landed):
    bought = [{"type": "PACKAGE", "id": "x", "price": {"amount": "9.5", "currency": "EUR"}, "available": True}, {}]
    body = {"schedule": [schedule_entry("2026-01-01"), schedule_entry("2026-01-02", purchases=bought)]}
    docs = validate.documents(landed(("/entity/d/schedule", body)), "schedule")
    rows = flatten.purchases(flatten.schedule(docs)).orderBy("ord").collect()
    assert [(r.entry_ord, r.type, r.price and r.price.amount, r.available) for r in rows] == [
        (1, "PACKAGE", 9.5, True),
        (1, None, None, None),
    ]


def test_tags(landed):
    values = ["text", 4, 4.5, True, {"a": 1}, None]
    tags = [{"tag": f"t{i}", "tagName": "T", "value": v} for i, v in enumerate(values)]
    head = {"id": "e", "name": "E", "entityType": "HOTEL", "timezone": "UTC"}
    good, listed = {**head, "tags": tags}, {**head, "tags": [{"tag": "t", "tagName": "T", "value": [1]}]}
    rows = flatten.tags(flatten.entities(validate.documents(landed(("/entity/e", good)), "entity")))
    kinds = [r.value_kind for r in rows.orderBy("ord").collect()]
    assert kinds == ["STRING", "NUMBER", "NUMBER", "NUMBER", "OBJECT", None]
    assert broken_rules(landed, "entity", "/entity/e", good, listed, {"id": "e"})[1:] == [
        {("VAL7", "tags.value")},
        {("VAL2", f) for f in ("name", "entityType", "timezone")},
    ]


def test_numbers_for_ids_are_tolerated(landed):
    rows = flatten.live(validate.documents(landed((LIVE, live_doc(entry(id=7)))), "live"))
    assert rows.select(F.col("id")).first().id == "7"


@pytest.mark.parametrize(("kind", "lists"), [("destinations", 2), ("entity", 1), ("children", 1), ("live", 4), ("schedule", 5)])
def test_a_document_is_checked_in_one_pass_over_each_of_its_lists(kind, lists):
    """all checks of a list's elements are tried together; only broken documents are told rule by rule."""
    assert validate._any_broken(validate.CHECKS[kind], "doc").count("exists(") == lists
    once, told = validate._broken_rules(validate._LEVEL, "doc").split(" THEN array(", 1)
    assert once.count("exists(") == 2 < told.count("exists(")


def test_one_pass_finds_what_the_rules_find(landed):
    """Each fault alone, in and below lists: a document is invalid exactly where some rule says so."""
    hours = {"type": "Open", "startTime": "2026-05-01T09:00:00Z"}
    entries = [
        entry(),
        *[entry(showtimes=t) for t in ([hours], [hours, None], [hours, {}], [hours | {"endTime": "2026-05-01T09:00"}], None, [])],
        *[entry(operatingHours=t) for t in ([hours, hours], [None], [{"type": None}], [hours | {"startTime": "soon"}])],
        *[entry(diningAvailability=t) for t in ([{"partySize": "2"}], [{}], [None], [{"partySize": "two"}], [{"waitTime": "x"}])],
        entry(lastUpdated="2025-07-03T18:20:00"), entry(status="OPEN"), entry(name=None), None,
    ]
    item = {"type": "PACKAGE", "price": {"amount": 1, "currency": "USD"}, "available": True}
    items = [[item], [item, None], [item | {"type": "X"}], [item | {"price": {"amount": 1}}], [item | {"price": {"currency": "USD"}}]]
    items += [[item | {"price": {"amount": "x", "currency": "USD"}}], [item | {"available": "maybe"}], [], None]
    day = {"date": "2026-05-01", "type": "INFO", "openingTime": "2026-05-01T09:00:00Z", "closingTime": "2026-05-01T10:00:00Z"}
    days = [[day | {"purchases": i}] for i in items] + [[day, None], [day | {"date": None}], [day | {"type": "X"}], [day | {"closingTime": "10:00"}], []]
    pages = [{"id": "a", "schedule": d} for d in days]
    pages += [{"id": "a", "parks": [{"id": "p", "schedule": d}]} for d in days] + [{"id": "a", "parks": [None]}, {"id": "a", "parks": [{"entityType": "X"}]}]
    for kind, path, bodies in (("live", LIVE, [live_doc(entry(), e) for e in entries]), ("schedule", "/entity/a/schedule", pages)):
        responses = landed(*[(path, b) for b in bodies])
        invalid = {r.seq for r in validate.check(responses, kind).where("NOT valid").collect()}
        told = {r.seq: {(v.rule, v.field) for v in r.told} for r in validate.rejects(responses, kind).groupBy("seq").agg(F.collect_set(F.struct("rule", "field")).alias("told")).collect()}
        assert invalid == set(told) and 0 < len(invalid) < len(bodies)
        if kind == "schedule":
            levels = validate.schedule_levels(responses)
            found = {r.seq: {(v.rule, v.field) for v in r.told} for r in levels.rejects.groupBy("seq").agg(F.collect_set(F.struct("rule", "field")).alias("told")).collect()}
            assert found == told
