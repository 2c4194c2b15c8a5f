"""Operators against plain-Python answers on small inputs."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from queuelake.operators import attempts, directory, freshness, geo, hierarchy, ingest, live, schedule
from queuelake.sources import bronze

DIRECTORY = "ord int, slug string, name string, id string"


def letters(s):
    return "".join(c for c in (s or "").lower() if c.isalnum())


def first_match(rows, query):
    needle = letters(query)
    hits = [r for r in sorted(rows) if needle and any(needle in letters(v) for v in r[1:3])]
    return hits[0] if hits else None


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ("big-wonder-world", "bww"),
        ("castle land europe", "cle"),
        ("bigwonderworldresort", "bww"),
        ("Land", "bww"),
        ("CASTLE-land", "cle"),
        ("nowhere", None),
        ("   ", None),
        ("?!", None),
    ],
)
def test_find(spark, query, expected):
    rows = [
        (0, "big-wonder-world", "Big Wonder World Resort & Landing", "bww"),
        (1, "castleland-europe", "Castle Land, Europe", "cle"),
        (2, None, None, "nameless"),
    ]
    found = directory.find(spark.createDataFrame(rows, DIRECTORY), query).collect()
    assert [r.id for r in found] == ([] if expected is None else [expected])


def test_find_many_equals_find(spark):
    rng = random.Random(5)

    def label(n):
        return "".join(rng.choice("ab -É") for _ in range(rng.randint(0, n)))

    rows = [(i, label(9), label(14), f"d{i}") for i in range(120)]
    rows += [(120, None, "same", "x"), (121, "", None, "y")]
    queries = [label(6) for _ in range(150)] + ["a"] * 60 + ["", "!!", "same", "SAME", "zzz", None, "a" * 40]
    got = directory.find_many(
        spark.createDataFrame(rows, DIRECTORY), spark.createDataFrame([(q,) for q in queries], "q string")
    )
    clean = [(o, s or "", n or "", i) for o, s, n, i in rows]
    expected = Counter((q, (first_match(clean, q or "") or (None,) * 4)[3]) for q in queries)
    assert Counter((r.q, r.id) for r in got.collect()) == expected


def entries_frame(spark, rows):
    """(entity_id, page, date, type) with the page as 'yyyy-mm'."""
    flat = [(i, 0, e, int(p[:4]), int(p[5:]), d, t) for i, (e, p, d, t) in enumerate(rows)]
    return spark.createDataFrame(
        flat, "seq bigint, ord int, entity_id string, year int, month int, date string, type string"
    )


def test_range_crosses_months_and_years_in_order(spark):
    pages = [
        ("e", "2026-12", "2026-12-31", "INFO"),
        ("e", "2027-01", "2027-01-02", "OPERATING"),
        ("e", "2027-01", "2027-01-01", "EXTRA_HOURS"),
        ("e", "2027-01", "2026-12-31", "INFO"),  # overlapping page: kept
        ("e", "2026-12", "2026-12-29", "INFO"),
        ("f", "2027-01", "2027-01-02", "INFO"),
    ]
    frame = entries_frame(spark, pages)
    start, end = dt.date(2026, 12, 30), dt.date(2027, 1, 5)
    got = schedule.range_report(frame, start, end, "e").collect()
    assert [(r.date, r.month) for r in got] == [("2026-12-31", 12), ("2026-12-31", 1), ("2027-01-01", 1), ("2027-01-02", 1)]
    assert schedule.range_report(frame, end, start).count() == 0
    assert schedule.entries_between(frame, dt.date(2027, 1, 2), dt.date(2027, 1, 2)).count() == 2
    assert schedule.of_type(frame, "OPERATING").count() == 1


def test_many_ranges(spark):
    rng = random.Random(7)
    days = [dt.date(2025, 11, 1) + dt.timedelta(d) for d in range(150)]

    def some_day():
        return rng.choice(days)

    pages = []
    for _ in range(400):
        d = some_day()
        pages.append((rng.choice("eeefg"), d.isoformat()[:7], d.isoformat(), "INFO"))
    requests = [(i, rng.choice("eefgz"), some_day().isoformat(), some_day().isoformat()) for i in range(60)]
    frame = entries_frame(spark, pages)
    asked = spark.createDataFrame(requests, "req_id int, entity_id string, start_date string, end_date string")
    expected = Counter(
        (q, i) for q, e, a, b in requests for i, (pe, _, d, _) in enumerate(pages) if pe == e and a <= d <= b
    )
    assert Counter((r.req_id, r.seq) for r in schedule.ranges(asked, frame).collect()) == expected
    counts = {r.req_id: r.entries for r in schedule.range_counts(asked, frame).collect()}
    assert counts == {q: sum(n for (p, _), n in expected.items() if p == q) for q, *_ in requests}


def test_manifest_has_each_page_once(spark):
    requests = [(1, "a b", "2026-12-30", "2027-01-05"), (2, "a b", "2027-01-01", "2027-01-31"), (3, "c", "2026-02-01", "2026-01-01")]
    asked = spark.createDataFrame(requests, "req_id int, entity_id string, start_date string, end_date string")
    got = sorted(r.path for r in ingest.manifest(asked).collect())
    assert got == ["/entity/a%20b/schedule/2026/12", "/entity/a%20b/schedule/2027/01"]


def test_manifest_holds_spans_instead_of_pages(spark):
    rng = random.Random(5)
    days = [dt.date(1999, 10, 1) + dt.timedelta(days=17 * i) for i in range(60)]
    requests = [(i, rng.choice(["a b", "c/d", "e", None]), rng.choice(days).isoformat(), rng.choice(days).isoformat()) for i in range(200)]
    requests += [(200, "e", "0000-11-30", "0001-02-01"), (201, "e", "soon", "2000-01-01"), (202, None, "2000-01-01", None), (203, "f", "2000-05-02", "2000-05-01")]
    asked = spark.createDataFrame(requests, "req_id int, entity_id string, start_date string, end_date string")
    got, whole = ingest.manifest(asked), ingest.month_paths(asked).select("path").distinct()
    assert got.columns == ["path"] and Counter(got.collect()) == Counter(whole.collect())
    # What follows the pages keeps none of them: no shuffle, sort or aggregate stands above them.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate explode")]
    assert not [step for step in ("Aggregate", "Window", "Sort", "Deduplicate") if step in above]


def test_descendants_of_any_depth(spark):
    rng = random.Random(3)
    parent = {f"n{i}": (f"n{rng.randrange(max(1, i // 2))}" if i else None) for i in range(200)}
    parent.update({f"chain{i}": f"chain{i - 1}" for i in range(1, 12)})
    expected = set()
    for node in parent:
        up, depth = parent.get(node), 1
        while up is not None:
            expected.add((up, node, depth))
            up, depth = parent.get(up), depth + 1
    edges = spark.createDataFrame(list(parent.items()), "id string, parent_id string")
    closure = hierarchy.descendant_closure(edges)
    rows = [tuple(r) for r in closure.select("root_id", "id", "depth").collect()]
    assert len(rows) == len(expected) and set(rows) == expected
    assert hierarchy.below(closure, "chain9").count() == 2


def test_cyclic_links_are_an_error(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "a")], "id string, parent_id string")
    with pytest.raises(ValueError, match="cyclic"):
        hierarchy.descendant_closure(edges)


STORED = "seq bigint, path string, fetched_at timestamp, status int, content_type string, body string"


def stored_frame(spark, rows):
    return spark.createDataFrame(
        [(s, p, t, status, "application/json", b) for s, p, t, status, b in rows], STORED
    )


def limit_of(path):
    if path == "/destinations" or path.endswith("/children"):
        return 3600
    return 300 if "/schedule" in path else 0


def answer(stored, path, moment):
    known = [r for r in stored if r[1] == path and r[2] <= moment and 200 <= r[3] < 300 and limit_of(path)]
    newest = max(known, key=lambda r: (r[2], r[0]), default=None)
    if newest is None or newest[4] is None:
        return None
    return newest[0] if moment < newest[2] + dt.timedelta(seconds=limit_of(path)) else None


def test_fresh_hits_equal_a_replay(spark):
    rng = random.Random(11)
    begin = dt.datetime(2026, 4, 14, 22, 30)
    places = ["/destinations"] * 3 + ["/entity/a/children", "/entity/a/schedule", "/entity/a/live", "/odd"]

    def moment():
        # a coarse grid gives ties, the fine part falls inside one second
        return begin + dt.timedelta(seconds=rng.choice([0, 1, 299, 300, 3599, 3600]) + rng.randrange(0, 20000, 250), microseconds=rng.choice([0, 1, 500]))

    stored = [(i, rng.choice(places), moment(), rng.choice([200, 200, 204, 503]), rng.choice(["{}", "{}", None])) for i in range(300)]
    asked = [(1000 + i, rng.choice(places), moment()) for i in range(300)]
    asked += [(2000 + i, r[1], r[2] + dt.timedelta(seconds=d)) for i, r in enumerate(stored[:60]) for d in (0, 300, 3600)]
    asked = [(i, p, t) for i, (_, p, t) in enumerate(asked)]
    requests = spark.createDataFrame(asked, "seq bigint, path string, requested_at timestamp")
    got = {r.seq: r.stored_seq for r in freshness.fresh_hits(requests, stored_frame(spark, stored)).collect()}
    expected = {i: answer(stored, p, t) for i, p, t in asked}
    assert got == expected
    assert 50 < sum(v is not None for v in expected.values()) < len(expected) - 50


def test_to_fetch(spark):
    now = dt.datetime(2026, 4, 14, 12, 0)

    def ago(seconds):
        return now - dt.timedelta(seconds=seconds)

    stored = [
        (1, "/destinations", ago(3599), 200, "{}"),
        (2, "/entity/a/children", ago(3600), 200, "{}"),
        (3, "/entity/a/live", ago(1), 200, "{}"),
        (4, "/entity/b", ago(10), 200, None),
        (5, "/entity/c", ago(10), 500, "{}"),
        (6, "/entity/a/schedule", ago(400), 200, "{}"),
        (7, "/entity/a/schedule", ago(100), 200, "{}"),
        (8, "/entity/d", now + dt.timedelta(seconds=5), 200, "{}"),
    ]
    wanted = sorted({r[1] for r in stored} | {"/entity/new"})
    frame = spark.createDataFrame([(p,) for p in wanted], "path string")
    got = sorted(r.path for r in ingest.to_fetch(frame, stored_frame(spark, stored), F.lit(now)).collect())
    assert got == [p for p in wanted if p not in ("/destinations", "/entity/a/schedule")]


def test_newest_per_path(spark):
    t = dt.datetime(2026, 1, 1)
    stored = [(1, "/a", t, 200, "old"), (2, "/a", t, 200, "new"), (3, "/a", t, 500, "bad"), (4, "/b", t, 200, "b")]
    got = {r.path: (r.seq, r.body) for r in bronze.newest_per_path(stored_frame(spark, stored)).collect()}
    assert got == {"/a": (2, "new"), "/b": (4, "b")}


ATTEMPTS = (
    "request_id int, attempt int, url string, received_at timestamp, status int, reason string, failure string,"
    " retry_after string, content_type string, body string"
)


def attempt_frame(spark, *rows):
    at = dt.datetime(2026, 4, 14)
    full = [(r, n, f"/u{r}", at, status, "R", failure, hint, "text/plain", "b") for r, n, status, failure, hint in rows]
    return spark.createDataFrame(full, ATTEMPTS)


def test_retry_rules(spark):
    log = attempt_frame(
        spark,
        (1, 0, 429, None, "3"), (1, 1, 429, None, None), (1, 3, 429, None, "3"),
        (2, 0, 502, None, "9"), (2, 3, 500, None, None),
        (3, 0, None, "timeout", None), (4, 2, None, "network", None),
        (5, 0, 404, None, None), (5, 0, 301, None, None), (5, 0, 204, None, None),
    )
    rows = attempts.with_retry_wait(log).orderBy("request_id", "attempt", "status").collect()
    got = [(r.outcome, r.retryable, r.wait_low, r.wait_high) for r in rows]
    assert got == [
        ("rate_limited", True, 3.0, 3.0),
        ("rate_limited", True, 0.5, 0.625),
        ("rate_limited", False, None, None),
        ("server_error", True, 0.25, 0.3125),
        ("server_error", False, None, None),
        ("timeout", False, None, None),
        ("network", True, 1.0, 1.25),
        ("ok", False, None, None),
        ("api_error", False, None, None),
        ("api_error", False, None, None),
    ]
    strict = attempts.with_retry_rule(log, max_retries=1, respect_429=False)
    assert {(r.outcome, r.attempt) for r in strict.where("retryable").collect()} == {("server_error", 0)}


def test_final_outcomes_and_dead_letters(spark):
    log = attempt_frame(
        spark,
        (1, 0, 429, None, "0"), (1, 1, 200, None, None),
        (2, 0, 502, None, None), (2, 1, 502, None, None), (2, 2, 429, None, "7"),
        (3, 0, None, "network", None), (3, 1, None, "timeout", None),
        (4, 0, None, "network", None),
    )
    finals = attempts.final_outcomes(log)
    assert {r.request_id: (r.outcome, r.attempts) for r in finals.collect()} == {
        1: ("ok", 2), 2: ("rate_limited", 3), 3: ("timeout", 2), 4: ("network", 1),
    }
    assert [r.request_id for r in attempts.successes(finals).collect()] == [1]
    letters_ = {r.request_id: (r.message, r.retry_after_seconds) for r in attempts.dead_letters(finals).collect()}
    assert letters_ == {
        2: ("429 R: b", 7.0),
        3: ("request to /u3 timed out", None),
        4: ("network error calling /u4", None),
    }


def live_frame(spark, rows):
    """(seq, ord, id, name, minutes, wait)."""
    schema = (
        "seq bigint, ord int, id string, name string, status string, last_updated timestamp,"
        " queue struct<STANDBY:struct<waitTime:double>>"
    )
    at = dt.datetime(2026, 1, 1)
    full = [
        (s, o, i, n, "OPERATING", at + dt.timedelta(minutes=m), None if w == "none" else ((w,),) if w != "absent" else (None,))
        for s, o, i, n, m, w in rows
    ]
    return spark.createDataFrame(full, schema)


def test_boards(spark):
    rows = live_frame(
        spark,
        [(0, 0, "a", "Zebra", 0, 45.9), (0, 1, "b", "apple", 0, None), (0, 2, "c", "Apple", 0, 60.0),
         (0, 3, "d", "Mango", 0, "none"), (0, 4, "e", "Lime", 0, 45.1), (0, 5, "f", "Kiwi", 0, "absent"),
         (0, 6, "g", "Down", 0, -3.7), (0, 7, "h", "Odd", 0, float("nan"))],
    )
    by_name = [(r.name, r.wait) for r in live.board_by_name(rows).collect()]
    assert by_name == [("Apple", 60), ("Down", -3), ("Kiwi", None), ("Lime", 45), ("Mango", None), ("Odd", None), ("Zebra", 45), ("apple", None)]
    longest = [(r.id, r.wait) for r in live.longest_waits(rows).collect()]
    assert longest == [("c", 60), ("a", 45), ("e", 45), ("g", -3)]


def test_current_state_takes_the_newest_update(spark):
    rows = live_frame(spark, [(5, 0, "a", "old", 9, 1.0), (3, 0, "a", "new", 10, 2.0), (4, 0, "a", "same", 10, 3.0), (1, 0, "b", "only", 0, "none")])
    got = {r.id: (r.name, r.seq) for r in live.current_state(rows, "name").collect()}
    assert got == {"a": ("same", 4), "b": ("only", 1)}


def test_geo(spark):
    rows = [("SHOW", "b", 1.0, 2.0), ("SHOW", "a", 1.0, 2.0), ("HOTEL", "h", None, 2.0), ("HOTEL", "i", 1.0, None), ("PARK", "p", 0.0, 0.0)]
    frame = spark.createDataFrame(rows, "entity_type string, name string, latitude double, longitude double")
    assert {tuple(r) for r in geo.count_by_type(frame).collect()} == {("SHOW", 2), ("PARK", 1)}
    assert [r.name for r in geo.listing_by_type(frame).collect()] == ["p", "a", "b"]
