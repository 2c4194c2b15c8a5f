"""Inputs that used to lose rows or answers: repeated and deep links, large numbers, odd dates, unrouted responses."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from queuelake.functions import http, times
from queuelake.functions import live as live_functions
from queuelake.operators import hierarchy, schedule
from queuelake.plans import lake
from queuelake.plans.queries import QUERIES
from queuelake.session import scratch_path
from queuelake.sources import silver


def test_newest_payload_is_found_among_all_events(spark):
    sf = "/root/testdata/sf0.001"
    landed = lake.landed_traffic(spark, sf).collect()
    assert len(landed) == spark.read.parquet(f"{sf}/events.parquet").count() == len({r.body for r in landed})
    newest = {}
    for r in sorted(landed, key=lambda r: (r.fetched_at, r.seq)):
        newest[r.path] = (r.seq, r.body)
    found = QUERIES["q46_newest_payload"](spark, sf).collect()
    assert {r.path: (r.seq, r.body) for r in found} == newest and {r.seq % 2 for r in found} == {0, 1}


def test_closure_counts_repeated_links_once_and_goes_as_deep_as_they_do(spark):
    chain = [(f"n{i:03d}", f"n{i - 1:03d}" if i else None) for i in range(12)]
    found = hierarchy.descendant_closure(spark.createDataFrame(chain * 3, "id string, parent_id string")).collect()
    expected = {(f"n{a:03d}", f"n{b:03d}", b - a) for a in range(12) for b in range(a + 1, 12)}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_closure_raises_on_a_cycle(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "c")], "id string, parent_id string")
    with pytest.raises(ValueError, match="cyclic"):
        hierarchy.descendant_closure(links)


def test_long_waits_stay(spark):
    rows = spark.createDataFrame([(3e9,), (float("nan"),), (float("inf"),), (7.9,), (None,)], "v double")
    queue = F.struct(F.struct(F.col("v").alias("waitTime")).alias("STANDBY"))
    assert [r[0] for r in rows.select(live_functions.current_wait_time(queue)).collect()] == [3000000000, None, None, 7, None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("200000000000000", "8307-10-"),
        ("1776153600", "2026-04-14 08:00:00"),
        ("9" * 30, None),
        ("2026-04-14t08:00:00z", "2026-04-14 08:00:00"),
        ("2026-04-14_08:00Z", "2026-04-14 08:00:00"),
        ("2026-04-14T10:00:00+02", "2026-04-14 08:00:00"),
        ("2026-04-14T08:00:00", None),
    ],
)
def test_payload_instants(evaluate, text, expected):
    [got] = evaluate([(text,)], "v string", F.expr(times.aware_instant("v")).cast("string"))
    assert got is None if expected is None else got.startswith(expected)


@pytest.mark.parametrize(
    ("text", "zone", "expected"),
    [
        ("2026-04-14T09:00:00+01", "Europe/Paris", "2026-04-14 08:00:00"),
        ("20260414T090000Z", "Europe/Paris", "2026-04-14 09:00:00"),
        ("20260414", "UTC", "2026-04-14 00:00:00"),
        ("2026-W16-2T09:00", "UTC", "2026-04-14 09:00:00"),
        ("2026W162", "UTC", "2026-04-14 00:00:00"),
        ("2026-04-14T09:00:00,5Z", "UTC", "2026-04-14 09:00:00.5"),
        ("2026-04-14T09:00:00", "America/New_York", "2026-04-14 13:00:00"),
        ("2026-04-14T09:00:00", "EST", "2026-04-14 14:00:00"),
        ("2026-04-14T09:00:00", "Etc/GMT+5", "2026-04-14 14:00:00"),
        ("2026-04-14T09:00:00", "+01:00", None),
        ("2026-04-14T09:00:00", "UTC+1", None),
        ("2026-04-14T09:00:00", "Nowhere/Land", None),
    ],
)
def test_date_texts(evaluate, text, zone, expected):
    assert evaluate([(text, zone)], "v string, tz string", times.parse_api_datetime("v", "tz").cast("string")) == [expected]


@pytest.mark.parametrize(
    ("hint", "ahead"),
    [
        ("Tue, 14 Apr 2026 12:10:00 GMT", 600),
        ("Tue, 14 Apr 2026 14:10:00 +0200", 600),
        ("Tue, 14 Apr 2026 12:10:00 -0000", 600),
        ("Tue, 14 Apr 2026 07:10:00 EST", 600),
        ("Tue, 14 Apr 2026 08:10:00 EDT", 600),
        ("14 Apr 2026 12:10 GMT", 600),
        ("Tuesday, 14-Apr-26 12:10:00 GMT", 600),
        ("Tue Apr 14 12:10:00 2026", 600),
        ("Tue, 14 Apr 2026 11:00:00 GMT", 0),
        ("Tue, 31 Feb 2026 11:00:00 GMT", None),
        ("soon", None),
        (None, None),
    ],
)
def test_retry_hints(evaluate, hint, ahead):
    at = F.lit("2026-04-14 12:00:00").cast("timestamp")
    assert evaluate([(hint,)], "v string", http.retry_after_seconds(F.col("v"), at)) == [ahead]


def test_requests_with_unpadded_and_bad_dates(spark):
    entries = spark.createDataFrame([("e", 2026, 4, "2026-04-05"), ("e", 2026, 4, "2026-04-20")], "entity_id string, year int, month int, date string")
    asked = [(1, "e", "2026-4-1", "2026-4-10"), (2, "e", "April", "2026-04-10"), (3, "e", "2026-04-01", None)]
    requests = spark.createDataFrame(asked, "req_id int, entity_id string, start_date string, end_date string")
    assert [(r.req_id, r.date) for r in schedule.ranges(requests, entries).collect()] == [(1, "2026-04-05")]
    assert {r.req_id: r.entries for r in schedule.range_counts(requests, entries).collect()} == {1: 1, 2: 0, 3: 0}
    assert {r.req_id for r in schedule.bad_requests(requests).collect()} == {2, 3}
    dates = spark.createDataFrame([(4, "e", dt.date(2026, 4, 1), dt.date(2026, 4, 30))], "req_id int, entity_id string, start_date date, end_date date")
    assert schedule.ranges(dates, entries).count() == 2


def test_every_response_is_stored_or_rejected(spark, landed):
    good = {"liveData": []}
    responses = landed(("/entity/a/live", good), ("/entity/b/live", "{broken"), ("/other/path", good), ("/destinations", {"destinations": []}))
    failed = landed(("/entity/c/live", good), status=503).withColumn("seq", F.lit(9).cast("bigint"))
    location = scratch_path(spark, "silver")
    silver.store(responses.union(failed), location, "one")
    seen = sum(silver.read(spark, location, f"documents/{kind}").count() for kind in silver.TABLES)
    rejects = silver.read(spark, location, "rejects/unrouted")
    assert {(r.path, r.rule, r.field) for r in rejects.collect()} == {("/other/path", "ROUTE", "path"), ("/entity/c/live", "ROUTE", "status")}
    assert seen + rejects.count() == 5
    assert [r.rule for r in silver.read(spark, location, "rejects/live").collect()] == ["VAL1"]
    assert silver.read(spark, location, "schedule").count() == 0
    assert {r.delivery for r in rejects.collect()} == {"one"}
