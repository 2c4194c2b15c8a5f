import datetime as dt
from email.utils import parsedate_to_datetime
from urllib.parse import quote
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from queuelake.functions import http, numbers, paths, text, times

UTC = dt.timezone.utc


def test_normalize_keeps_letters_and_digits(evaluate):
    samples = ["Blue-Ring  7!", "ÉCOLE d'Été", "  ", "!?", "東京 Park", "", None]
    expected = [None if s is None else "".join(c for c in s.lower() if c.isalnum()) for s in samples]
    assert evaluate([(s,) for s in samples], "s string", text.normalize(F.col("s"))) == expected


@pytest.mark.parametrize(
    ("value", "zone", "expected"),
    [
        ("2025-07-03T18:20:00-06:00", "America/Denver", (2025, 7, 4, 0, 20)),
        ("2025-07-04T00:20:00Z", "America/Denver", (2025, 7, 4, 0, 20)),
        ("2025-07-03T18:20:00", "America/Denver", (2025, 7, 4, 0, 20)),
        ("2026-04-14T09:00Z", "UTC", (2026, 4, 14, 9, 0)),
        ("2026-04-14T09:00", "Asia/Tokyo", (2026, 4, 14, 0, 0)),
        ("2026-04-14T09", "Asia/Tokyo", (2026, 4, 14, 0, 0)),
        ("2026-04-14 09:00:00+0530", "UTC", (2026, 4, 14, 3, 30)),
        ("2026-04-14T09:00:00.123456+05:30", "UTC", (2026, 4, 14, 3, 30, 0, 123456)),
        ("2026-04-14", "America/New_York", (2026, 4, 14, 4, 0)),
        ("2026-03-08T02:30:00", "America/New_York", (2026, 3, 8, 7, 30)),  # inside the spring gap
        ("2026-11-01T01:30:00", "America/New_York", (2026, 11, 1, 5, 30)),  # first of the two
    ],
)
def test_api_datetime(evaluate, value, zone, expected):
    got = evaluate(
        [(value, zone)], "v string, tz string", times.parse_api_datetime("v", "tz").cast("string")
    )
    want = dt.datetime(*expected)
    assert dt.datetime.fromisoformat(got[0]) == want
    parsed = dt.datetime.fromisoformat(value)
    local = parsed if parsed.tzinfo else parsed.replace(tzinfo=ZoneInfo(zone))
    assert local.astimezone(UTC).replace(tzinfo=None) == want


def test_bad_dates_are_null_or_fail_when_strict(spark, evaluate):
    bad = ["not a date", "2026-02-30T09:00:00Z", "2026", "2026-04", "T09:00:00Z", "", "2026-04-14 bad"]
    schema = "v string, tz string"
    rows = [(v, "UTC") for v in bad]
    assert evaluate(rows, schema, times.parse_api_datetime("v", "tz")) == [None] * len(bad)
    assert evaluate([("2026-04-14T09:00:00", "No/Zone")], schema, times.parse_api_datetime("v", "tz")) == [None]
    strict = times.parse_api_datetime("v", "tz", strict=True)
    assert evaluate([(None, "UTC")], schema, strict) == [None]
    with pytest.raises(Exception, match="invalid date: not a date"):
        evaluate([("not a date", "UTC")], schema, strict)


def test_aware_instant_casts_the_usual_form_as_it_is(evaluate):
    """The form that APIs write goes through no replacement, and means what the other forms mean."""
    sql = times.aware_instant("v")
    assert sql.index("try_cast(v AS TIMESTAMP)") < sql.index("regexp_replace")
    usual = ["2024-01-15T09:30:00Z", "2024-01-15T09:30:00.25Z", "2024-01-15T09:30:00+05:30", "2024-01-15T09:30:00-14:00", "2024-02-30T09:30:00Z", "2024-01-15T24:00:00Z", "2024-01-15T09:30:00+19:00"]
    other = [v.replace("T", "_") for v in usual]
    of = lambda cases: evaluate([(v,) for v in cases], "v string", F.expr(sql).cast("string"))
    assert of(usual) == of(other)
    assert of(usual)[:3] == ["2024-01-15 09:30:00", "2024-01-15 09:30:00.25", "2024-01-15 04:00:00"]
    assert of(usual)[4:] == [None, None, None]


def test_aware_instant_wants_an_offset_or_an_epoch(evaluate):
    cases = {
        "2026-04-14T09:00:00-04:00": "2026-04-14 13:00:00",
        "2026-04-14T09:00:00": None,
        "2026-04-14": None,
        "1700000000": "2023-11-14 22:13:20",
        "1.7E9": "2023-11-14 22:13:20",
        "1700000000000": "2023-11-14 22:13:20",
        "1E19": None,
        "soon": None,
    }
    got = evaluate(
        [(v,) for v in cases], "v string", F.expr(times.aware_instant("v")).cast("string")
    )
    assert got == list(cases.values())


def test_lax_numbers(evaluate):
    cases = {"30": 30.0, " 4.5 ": 4.5, "-1e2": -100.0, "true": 1.0, "false": 0.0, "1d": None, "x": None, "": None}
    assert evaluate([(v,) for v in cases], "v string", F.expr(numbers.lax_double("v"))) == list(cases.values())
    flags = {"true": True, "FALSE": False, "1": True, "off": False, "maybe": None}
    assert evaluate([(v,) for v in flags], "v string", F.expr(numbers.lax_boolean("v"))) == list(flags.values())


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [
        ("2026-03-20", "2026-05-10", ["2026-03", "2026-04", "2026-05"]),
        ("2026-12-30", "2027-01-05", ["2026-12", "2027-01"]),
        ("2026-05-01", "2026-05-01", ["2026-05"]),
        ("2026-05-01", "2026-03-01", []),
    ],
)
def test_months_touched(evaluate, start, end, expected):
    months = times.months_between_inclusive(F.col("a").cast("date"), F.col("b").cast("date"))
    got = evaluate([(start, end)], "a string, b string", months)[0]
    assert [m.isoformat()[:7] for m in got] == expected


def test_path_encoding_round_trip(evaluate):
    ids = ["".join(chr(c) for c in range(32, 127)), "é/ñ", "a+b", "", "ent-5"]
    rows = [(i,) for i in ids]
    encoded = evaluate(rows, "s string", paths.path_encode(F.col("s")))
    assert encoded == [quote(i, safe="") for i in ids]
    assert evaluate(rows, "s string", paths.path_decode(paths.path_encode(F.col("s")))) == ids
    assert evaluate([("a%ZZ",)], "s string", paths.path_decode(F.col("s"))) == [None]


def test_month_page_is_padded_year_is_not(evaluate):
    page = paths.month_path(F.col("id"), F.col("y"), F.col("m"))
    got = evaluate([("a b", 2026, 4), ("x", 987, 12)], "id string, y int, m int", page)
    assert got == ["/entity/a%20b/schedule/2026/04", "/entity/x/schedule/987/12"]


def test_routes_and_freshness_limits(evaluate):
    cases = {
        "/destinations": ("destinations", None, None, None, 3600),
        "/entity/abc-1": ("entity", "abc-1", None, None, 3600),
        "/entity/a%20b/children": ("children", "a b", None, None, 3600),
        "/entity/a+b/live": ("live", "a+b", None, None, 0),
        "/entity/abc/schedule": ("schedule", "abc", None, None, 300),
        "/entity/abc/schedule/2026/4": ("schedule", "abc", 2026, 4, 300),
        "/entity/abc/schedule/2026/04": ("schedule", "abc", 2026, 4, 300),
        "/entity/abc/schedule/2026": ("other", "abc", None, None, 0),
        "/entity/": ("other", None, None, None, 0),
        "/destinations/x": ("other", None, None, None, 0),
    }
    p = F.col("p")
    kind = paths.endpoint(p)
    row = F.struct(
        kind, paths.path_entity_id(p), paths.path_year(p), paths.path_month(p), paths.ttl_seconds(kind)
    )
    assert [tuple(r) for r in evaluate([(c,) for c in cases], "p string", row)] == list(cases.values())


def test_retry_after(evaluate):
    now = dt.datetime(2026, 4, 14, 12, 0, 0)
    ahead = "Tue, 14 Apr 2026 12:01:30 GMT"
    assert (parsedate_to_datetime(ahead).replace(tzinfo=None) - now).total_seconds() == 90
    cases = {
        "5": 5.0,
        " 2.5 ": 2.5,
        "-2": 0.0,
        "nan": 0.0,
        "Mon, 02 Mar 2020 10:15:00 GMT": 0.0,
        ahead: 90.0,
        "Tuesday, 14-Apr-26 12:00:10 GMT": 10.0,
        "Tue Apr 14 12:00:20 2026": 20.0,
        "whenever suits": None,
        "": None,
        None: None,
    }
    seconds = http.retry_after_seconds(F.col("v"), F.lit(now.isoformat(" ")).cast("timestamp"))
    assert evaluate([(v,) for v in cases], "v string", seconds) == list(cases.values())


def test_backoff_bounds(evaluate):
    n = F.col("n")
    bounds = F.struct(http.backoff_low(n), http.backoff_high(n))
    got = [tuple(r) for r in evaluate([(i,) for i in range(7)], "n int", bounds)]
    assert got == [(min(0.25 * 2**i, 5.0), min(0.25 * 2**i * 1.25, 5.0)) for i in range(7)]


def test_error_messages(evaluate):
    json, plain = "application/json; charset=utf-8", "text/plain"
    cases = [
        ((400, "Bad Request", json, '{"error":"no such ride"}'), "400 Bad Request: no such ride"),
        ((400, "Bad Request", json, '{"error":null}'), "400 Bad Request: None"),
        ((404, "Not Found", json, '{"why":"closed"}'), '404 Not Found: {"why":"closed"}'),
        ((404, "Not Found", plain, ""), "404 Not Found"),
        ((404, "Not Found", json, None), "404 Not Found"),
        ((404, "Not Found", json, "<html>"), "404 Not Found"),
        ((500, "Oops", plain, "z" * 333), "500 Oops: " + "z" * 200 + "..."),
        ((500, "Oops", plain, "x" * 200), "500 Oops: " + "x" * 200),
        ((500, "Oops", json, '{"error":"' + "y" * 400 + '"}'), ("500 Oops: " + "y" * 400)[:300]),
        ((500, "Oops", plain, '{"error":"text"}'), '500 Oops: {"error":"text"}'),
    ]
    message = http.error_message(F.col("s"), F.col("r"), F.col("c"), F.col("b"))
    got = evaluate([c[0] for c in cases], "s int, r string, c string, b string", message)
    assert got == [c[1] for c in cases]


def test_json_bodies_by_content_type(evaluate):
    rows = [("application/json",), ("application/json; charset=utf-8",), ("text/plain",), (None,)]
    assert evaluate(rows, "c string", http.is_json_body(F.col("c"))) == [True, True, False, False]


def test_texts_that_are_no_instant(evaluate):
    """what a look at the text settles is what the cast would have said."""
    days = [f"{y}-{m}-{d}" for y in ("0000", "0001", "2024", "2023", "9999") for m in ("00", "01", "02", "04", "12", "13") for d in ("00", "01", "28", "29", "30", "31", "32")]
    clocks = ["00:00:00", "23:59:59", "24:00:00", "12:60:00", "12:00:60", "12:00:00.1", "12:00:00.123456", "12:00:00.1234567", "12:00:00.", "12:00", "12"]
    ends = ["Z", "z", "", "+00:00", "-00:00", "+17:59", "-17:59", "+18:00", "+18:01", "-12:60", "+1:00", "+0100", "Z\n", "Z\u2028", "Z ", "ZZ"]
    texts = [f"{day}T00:00:00Z" for day in days] + [f"2024-02-28{t}{clock}{end}" for t in "Tt _" for clock in clocks for end in ends]
    texts += [" 2024-01-01T00:00:00Z", "x2024-01-01T00:00:00Z", "12024-01-01T00:00:00Z", "1704067200", "1e999", "", None]
    bad = evaluate([(t,) for t in texts], "v string", F.expr(times.no_instant("v")))
    cast = evaluate([(t,) for t in texts], "v string", F.expr(times.aware_instant("v")).cast("string"))
    assert bad == [t is not None and c is None for t, c in zip(texts, cast, strict=True)]
    assert 100 < sum(bad) < len(texts) - 50
