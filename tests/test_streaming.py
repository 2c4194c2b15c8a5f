"""Streams give what the batch jobs give on the same files."""

import json

import pytest
from pyspark.sql import functions as F

from queuelake.operators import flatten, live
from queuelake.plans import lake
from queuelake.schemas import BRONZE
from queuelake.session import scratch_path
from queuelake.sources.deliveries import folders
from queuelake.sources import validate
from queuelake.streaming import attempts as log_stream
from queuelake.streaming import live as stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feed(spark):
    location = scratch_path(spark, "feed")
    responses = lake.live_responses(lake.polls(spark, SF)).select(*BRONZE.names)
    responses.repartition(5).write.json(location)
    return location


def batch_rows(spark, location):
    return flatten.live(validate.documents(spark.read.schema(BRONZE).json(location), "live"))


def follow(spark, rows, name):
    table = scratch_path(spark, name)
    stream.append_table(rows, table, scratch_path(spark, f"{name}-state")).awaitTermination()
    return spark.read.parquet(table)


@pytest.mark.parametrize("ties", [False, True])
def test_a_followed_table_is_dealt_to_many_files_a_batch(spark, tmp_path, ties):
    """Three batches, earlier rows first, each of many files and whole; also when nearly all rows are of one moment."""
    n = 130_000
    second = F.when(F.col("id") < 4, F.col("id")).otherwise(4) if ties else F.col("id")
    spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_seconds(second).cast("timestamp_ntz").alias("ts")).write.parquet(f"{tmp_path}/events.parquet")
    batches = []

    def note(batch, number):
        at = F.unix_seconds(F.col("ts").cast("timestamp"))
        batch = batch.select(at.alias("at"), F.input_file_name().alias("file"))
        batches.append(tuple(batch.agg(F.count("*"), F.count_distinct("file"), F.min("at"), F.max("at")).first()))

    events = lake.event_stream(spark, str(tmp_path)).select("*")
    events.writeStream.foreachBatch(note).option("checkpointLocation", scratch_path(spark, "noted")).trigger(availableNow=True).start().awaitTermination()
    assert sum(rows for rows, *_ in batches) == n and len(batches) == 3
    kept = [b for b in batches if b[0]]
    assert all(a[3] < b[2] for a, b in zip(kept, kept[1:]))
    assert all(files > 1 for rows, files, *_ in batches if rows > n // 4)


def test_offers_stream_equals_batch(spark, feed):
    responses = stream.read_responses(spark, feed, maxFilesPerTrigger="2")
    got = follow(spark, stream.offers(responses), "offers")
    expected = live.queue_offers(batch_rows(spark, feed))
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected.select(got.columns)).count() == 0


def test_board_stream_equals_batch(spark, feed):
    rows = live.with_wait(stream.live_rows(stream.read_responses(spark, feed, maxFilesPerTrigger="2")))
    table = scratch_path(spark, "board")
    stream.write_board(rows, table, scratch_path(spark, "board-state"), "name", "wait").awaitTermination()
    got = stream.read_board(spark, table)
    expected = live.current_state(live.with_wait(batch_rows(spark, feed)), "name", "wait")
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected.select(got.columns)).count() == 0


def test_unfinished_board_does_not_show(spark, feed):
    rows = live.with_wait(stream.live_rows(stream.read_responses(spark, feed, maxFilesPerTrigger="1")))
    table = scratch_path(spark, "board")
    stream.write_board(rows, table, scratch_path(spark, "board-state"), "name", "wait").awaitTermination()
    whole = stream.read_board(spark, table).count()
    assert stream.published(spark, table) == 4
    spark.range(3).write.parquet(f"{table}/versions/5")
    assert stream.read_board(spark, table).count() == whole > 3


def poll_file(folder, number, polls):
    lines = []
    for seq, (entity, minute) in enumerate(polls):
        at = f"2026-04-14T{minute // 60:02d}:{minute % 60:02d}:00Z"
        body = {"liveData": [{"id": entity, "name": entity, "entityType": "SHOW", "lastUpdated": at}]}
        lines.append(json.dumps({"seq": seq, "path": f"/entity/{entity}/live", "fetched_at": at, "status": 200,
                                 "content_type": "application/json", "body": json.dumps(body)}))
    (folder / f"{number}.json").write_text("\n".join(lines))


def test_repeated_polls_are_dropped_and_late_ones_too(spark, tmp_path):
    folder, table, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def run():
        rows = stream.live_rows(stream.read_responses(spark, str(folder)))
        seen = stream.first_sightings(rows.select("id", "last_updated"), "1 hour")
        stream.append_table(seen, table, state).awaitTermination()
        text = F.date_format("last_updated", "HH:mm")
        return sorted(tuple(r) for r in spark.read.parquet(table).select("id", text).collect())

    poll_file(folder, 1, [("a", 600), ("a", 600), ("b", 600), ("a", 605)])
    first = run()
    assert first == [("a", "10:00"), ("a", "10:05"), ("b", "10:00")]
    poll_file(folder, 2, [("a", 605), ("b", 600), ("b", 780)])  # repeats across batches, and time moves on
    second = run()
    assert second == sorted([*first, ("b", "13:00")])
    poll_file(folder, 3, [("c", 600), ("c", 775)])  # three hours late, and in time
    assert run() == sorted([*second, ("c", "12:55")])


def test_dedupe_equals_batch_without_late_rows(spark, feed):
    responses = stream.read_responses(spark, feed)
    rows = stream.live_rows(responses.withColumn("again", F.explode(F.array(F.lit(1), F.lit(2)))).drop("again"))
    got = follow(spark, stream.first_sightings(rows.select("id", "last_updated"), "1 hour"), "once")
    expected = batch_rows(spark, feed).select("id", "last_updated").distinct()
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0


def board_of(spark, table):
    text = F.date_format("last_updated", "HH:mm")
    return sorted(tuple(r) for r in stream.read_board(spark, table).select("id", text, "name").collect())


def buckets_written(spark, table, batch):
    return set(folders(spark, f"{table}/buckets/batch={batch}"))


def test_a_trigger_writes_the_buckets_it_changes(spark, tmp_path):
    folder, table, state = tmp_path / "in", str(tmp_path / "board"), str(tmp_path / "state")
    folder.mkdir()

    def run():
        rows = stream.live_rows(stream.read_responses(spark, str(folder)))
        stream.write_board(rows, table, state, "name", buckets=16).awaitTermination()
        return board_of(spark, table)

    everyone = [f"ride{i}" for i in range(60)]
    poll_file(folder, 1, [(e, 600) for e in everyone])
    assert run() == sorted((e, "10:00", e) for e in everyone)
    first = buckets_written(spark, table, 0)
    assert len(first) > 10
    poll_file(folder, 2, [("ride7", 610), ("ride7", 605), ("new", 590), ("ride8", 590)])  # the last is older than what is shown
    expected = sorted([(e, "10:10" if e == "ride7" else "10:00", e) for e in everyone] + [("new", "09:50", "new")])
    assert run() == expected
    assert len(buckets_written(spark, table, 1)) <= 3
    # Both versions can still be read; the one before goes when the next is published.
    assert folders(spark, f"{table}/published") == ["version=0", "version=1"]
    poll_file(folder, 3, [(e, 620) for e in [*everyone, "new"]])
    run()
    poll_file(folder, 4, [("ride1", 630)])
    run()
    assert folders(spark, f"{table}/published") == ["version=2", "version=3"]
    assert folders(spark, f"{table}/buckets") == ["batch=2", "batch=3"]


@pytest.mark.parametrize("published", [False, True])
def test_a_board_survives_a_batch_that_fails(spark, tmp_path, monkeypatch, published):
    """Repeated after it failed before or after it was published, a batch leaves the board it would have left."""
    folder, table, state = tmp_path / "in", str(tmp_path / "board"), str(tmp_path / "state")
    folder.mkdir()

    def run():
        rows = stream.live_rows(stream.read_responses(spark, str(folder)))
        stream.write_board(rows, table, state, "name", buckets=4).awaitTermination()

    poll_file(folder, 1, [("a", 600), ("b", 600), ("c", 600)])
    run()
    before = board_of(spark, table)
    poll_file(folder, 2, [("a", 610), ("d", 610)])

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(stream, "folders" if published else "write_table", lost if not published else lambda *a: lost() if a[1].endswith("buckets") else folders(*a))
        with pytest.raises(Exception, match="lost"):
            run()
    if not published:
        assert board_of(spark, table) == before
    run()
    assert board_of(spark, table) == [("a", "10:10", "a"), ("b", "10:00", "b"), ("c", "10:00", "c"), ("d", "10:10", "d")]


def attempt_file(folder, number, attempts):
    lines = []
    for request, attempt, second, status, hint in attempts:
        at = f"2026-04-14T10:{second // 60:02d}:{second % 60:02d}Z"
        lines.append(json.dumps({"request_id": request, "attempt": attempt, "url": f"/entity/{request}", "received_at": at, "status": status,
                                 "reason": "x", "retry_after": hint, "content_type": "text/plain", "body": f"body {attempt}"}))
    (folder / f"{number}.json").write_text("\n".join(lines))


def test_outcomes_are_told_when_no_retry_can_come(spark, tmp_path):
    """Over batches and restarts; a long hint keeps a request open; what comes after the end is kept apart."""
    folder, table, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    schema = ("request_id bigint, attempt int, url string, received_at timestamp, status int, reason string, failure string,"
              " retry_after string, content_type string, body string")  # fmt: skip

    def run():
        attempts = spark.readStream.schema(schema).json(str(folder))
        stream.append_table(log_stream.final_outcomes(attempts, "5 seconds", patience_seconds=20), table, state).awaitTermination()
        return sorted((r.request_id, r.attempts, r.attempt, r.outcome) for r in spark.read.schema(OUTCOMES).parquet(table).collect())

    attempt_file(folder, 1, [(1, 0, 0, 503, None), (2, 0, 1, 200, None), (3, 0, 2, 429, "100"), (1, 1, 9, 503, None)])
    assert run() == []
    attempt_file(folder, 2, [(1, 2, 15, 404, None), (4, 0, 60, 200, None)])  # joins what the first batch left open
    assert run() == [(1, 3, 2, "api_error"), (2, 1, 0, "ok")]
    attempt_file(folder, 3, [(3, 1, 101, 200, None), (2, 1, 4, 500, None), (5, 0, 160, 200, None)])  # as hinted; far too late
    found = run()
    assert found == [(1, 3, 2, "api_error"), (2, 1, 0, "ok"), (3, 2, 1, "ok"), (4, 1, 0, "ok")]
    outcomes = spark.read.parquet(table)
    letters = log_stream.dead_letters(outcomes).collect()
    assert [(r.request_id, r.message) for r in letters] == [(1, "404 x: body 2")]
    late = log_stream.late_attempts(spark.read.schema(schema).json(str(folder)), outcomes)
    assert [(r.request_id, r.attempt) for r in late.collect()] == [(2, 1)]
    attempt_file(folder, 4, [(2, 2, 100, 500, None)])  # beyond what its session was, and before the watermark
    assert run() == found
    late = log_stream.late_attempts(spark.read.schema(schema).json(str(folder)), outcomes)
    assert sorted((r.request_id, r.attempt) for r in late.collect()) == [(2, 1), (2, 2)]


OUTCOMES = "request_id bigint, attempts bigint, attempt int, status int, outcome string"


def test_bodies_are_no_state(spark, tmp_path):
    rows = log_stream.final_outcomes(lake.attempt_stream(spark, SF), "1 minute", at="logged_at")
    assert "body" not in rows.columns and rows.isStreaming
    assert {"message", "closed_at"} <= set(rows.columns)
