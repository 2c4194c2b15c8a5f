"""Mechanisms behind joins and closures: what moves, how often, and that nothing is lost."""

import datetime as dt
import random
from collections import Counter
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from queuelake.operators import directory, freshness, hierarchy, schedule
from queuelake.plans import lake
from queuelake.session import scratch_path
from queuelake.sources import bronze, colocated
from test_storage_and_plans import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcasts(spark):
    """Joins as over tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges_above(shown, scan):
    """Operators between a scan and the first join or aggregate above it, for every such scan of the plan tree."""
    lines = shown.split("\n\n")[0].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    out = []
    for i, line in enumerate(lines):
        if scan in line:
            path, d = [], depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < d:
                    d = depth[j]
                    path.append(lines[j])
            out.append(path)
    return out


def test_newest_per_path_moves_keys_only(spark, no_broadcasts):
    location = scratch_path(spark, "colocated")
    table = colocated.store_responses(lake.landed_traffic(spark, SF), f"t{uuid4().hex}", location, 4)
    newest = colocated.newest_per_path(table)
    expected = bronze.newest_per_path(lake.landed_traffic(spark, SF))
    assert sorted(map(tuple, newest.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    newest.write.format("noop").mode("overwrite").save()
    simple = newest._jdf.queryExecution().executedPlan().toString()
    for line in simple.splitlines():
        assert not ("Exchange" in line and "body" in line)
    # Of the two reads of the table, one is shuffled after it has shrunk to keys, the other not at all.
    lines = [line for line in simple.split("== Initial Plan ==")[-1].splitlines() if "Exchange" in line or "FileScan" in line]
    assert sum("hashpartitioning(path" in line for line in lines) == 2 and sum("FileScan" in line for line in lines) == 2
    again = colocated.open_table(spark, f"t{uuid4().hex}", location, table.schema, colocated.RESPONSE_KEYS, ("fetched_at", "seq"), 4)
    assert again.count() == table.count() and "Bucketed: true" in plan(again.groupBy("path", "day").count())


def test_ranges_leave_the_table_where_it_lies(spark, no_broadcasts):
    entries = lake.openings(spark, SF).select(
        "seq", F.lit(0).alias("ord"), F.col("id").alias("entity_id"), F.year("ts").alias("year"), F.month("ts").alias("month"), "date", "type"
    )
    table = colocated.store_entries(entries, f"t{uuid4().hex}", scratch_path(spark, "colocated"), 4)
    requests = lake.range_requests(spark, SF)
    found = schedule.ranges(requests, table)
    assert Counter(map(tuple, found.select("req_id", "seq").collect())) == Counter(
        map(tuple, schedule.ranges(requests, entries).select("req_id", "seq").collect())
    )
    simple = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert sum("Exchange" in line for line in simple.splitlines()) == 1  # the requests


def test_a_chain_of_a_thousand_takes_ten_rounds(spark, monkeypatch):
    rounds, real = [], hierarchy.stored
    monkeypatch.setattr(hierarchy, "stored", lambda frame, name: rounds.append(name) or real(frame, name))
    chain = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(1001)]
    closure = hierarchy.descendant_closure(spark.createDataFrame(chain, "id string, parent_id string"))
    assert closure.count() == 1000 * 1001 // 2 and len(rounds) <= 12
    assert closure.agg(F.max("depth"), F.countDistinct("root_id", "id")).first() == (1000, 500500)


def test_counts_of_pages_that_hold_other_months(spark):
    """Entries on the page of another month, with dates that are none, and ranges that touch only one of the two."""
    rng = random.Random(11)
    dates = ["2026-01-31", "2026-02-01", "2026-02-28", "2026-03-01", "2026-02-30", "2026-2-5", None, "soon"]
    entries = [(i, 0, rng.choice("ab"), 2026, rng.choice([1, 2, 3]), rng.choice(dates), "INFO") for i in range(300)]
    frame = spark.createDataFrame(entries, "seq bigint, ord int, entity_id string, year int, month int, date string, type string")
    days = [dt.date(2026, 1, 30) + dt.timedelta(d) for d in range(32)]
    asked = [(i, rng.choice("abc"), rng.choice(days).isoformat(), rng.choice(days).isoformat()) for i in range(80)] + [(99, "a", "nope", "2026-02-01")]
    requests = spark.createDataFrame(asked, "req_id int, entity_id string, start_date string, end_date string")
    expected = {r.req_id: 0 for r in requests.collect()} | {
        r.req_id: r["count"] for r in schedule.ranges(requests, frame).groupBy("req_id").count().collect()
    }
    assert {r.req_id: r.entries for r in schedule.range_counts(requests, frame).collect()} == expected


def test_a_long_range_costs_two_rows(spark):
    """A lookup at each end, whatever lies between."""
    entries = spark.range(3000).selectExpr(
        "id AS seq", "0 AS ord", "'e' AS entity_id", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS d"
    ).selectExpr("seq", "ord", "entity_id", "year(d) AS year", "month(d) AS month", "CAST(d AS STRING) AS date", "'INFO' AS type")
    requests = spark.createDataFrame([(i, "e", "2020-01-01", "2028-12-31") for i in range(50)], "req_id int, entity_id string, start_date string, end_date string")
    counts = schedule.range_counts(requests, entries)
    assert {r.entries for r in counts.collect()} == {3000}


def test_busy_paths_lie_in_many_parts(spark):
    """The last response is carried over parts without one; one path has nearly all moments."""
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    path = "/entity/e/children"

    def moment():
        return start + dt.timedelta(seconds=rng.randrange(40_000), microseconds=rng.randrange(3))

    stored = [(i, path if rng.random() < 0.9 else "/destinations", moment(), 200, "application/json", None if rng.random() < 0.1 else "{}") for i in range(30)]
    asked = [(1000 + i, path if rng.random() < 0.9 else "/destinations", moment()) for i in range(2000)] + [(1, None, start), (2, "/entity/e/live", start)]
    requests = spark.createDataFrame(asked, "seq bigint, path string, requested_at timestamp")
    responses = spark.createDataFrame(stored, "seq bigint, path string, fetched_at timestamp, status int, content_type string, body string")
    expected = {}
    for seq, p, at in asked:
        before = [(s[2], s[0], s[5]) for s in stored if s[1] == p and s[2] <= at]
        last = max(before, key=lambda x: x[:2], default=None)
        expected[seq] = last[1] if last and last[2] is not None and at < last[0] + dt.timedelta(seconds=3600) else None
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        found = freshness.fresh_hits(requests, responses)
        assert {r.seq: r.stored_seq for r in found.collect()} == expected
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_labels_meet_only_needles_of_rare_pieces(spark):
    """A needle of common pieces and one rare one meets the labels that have the rare one."""
    labels = spark.range(500).selectExpr("concat('mountainride', id, CASE WHEN id = 77 THEN 'zq' ELSE '' END) AS label")
    needles = spark.createDataFrame([("mountainride77zq",), ("mountainridexyz",), ("z",), ("zq",), ("ride49",)], "needle string")
    met = Counter(r.needle for r in directory.candidates(labels, needles).collect())
    assert met["mountainride77zq"] == 1 and met["mountainridexyz"] == 0 and met["z"] == met["zq"] == 1
    assert 11 <= met["ride49"] < 130  # e49 or de4, not every mountainride
