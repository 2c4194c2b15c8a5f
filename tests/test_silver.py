"""Deliveries: whole or not at all, once each, with counts that add up."""

import json
from threading import Barrier

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from queuelake.operators import flatten
from queuelake.plans import lake
from queuelake.plans.queries import QUERIES
from queuelake.schemas import BRONZE
from queuelake.session import checkpoint_dir, scratch_path
from queuelake.sources import bronze, deliveries, silver, sinks, validate
from queuelake.streaming import live as stream
from test_storage_and_plans import plan

SF = "/root/testdata/sf0.001"


def landing(spark):
    """Responses of several kinds, good and bad, failed ones, and ones of no kind."""
    faulty = lake.faulty_responses(spark, SF).select(*BRONZE.names)
    failed = F.when(F.col("seq") % 10 == 3, 500).otherwise(F.col("status"))
    # A few month pages: each is a folder of the stored table.
    pages = lake.schedule_responses(spark, SF).where("year = 1997 AND month < 4").select(*BRONZE.names)
    odd = pages.limit(7).withColumn("path", F.lit("/elsewhere"))
    return faulty.withColumn("status", failed).unionByName(pages).unionByName(odd)


@pytest.fixture(scope="module")
def feed(spark):
    location = scratch_path(spark, "feed")
    landing(spark).repartition(5, "seq").write.json(location)
    return location


def follow(spark, feed, location, state):
    responses = stream.read_responses(spark, feed, maxFilesPerTrigger="2")
    silver.follow(responses, location, state, "feed").awaitTermination()


def table_rows(spark, location, name):
    rows = silver.read(spark, location, name).drop("delivery")
    return sorted(map(repr, rows.select(sorted(rows.columns)).collect()))


NAMES = ("live", "offers", "schedule", "documents/live", "rejects/live", "rejects/unrouted", "purchases")


@pytest.fixture(scope="module")
def batch(spark, feed):
    location = scratch_path(spark, "batch")
    silver.store(spark.read.schema(BRONZE).json(feed), location, "all")
    return location


def test_everything_is_accepted_or_rejected(spark, batch):
    (m,) = deliveries.manifests(spark, batch).collect()
    assert m.responses == landing(spark).count() == sum(m.accepted.values()) + sum(m.rejected.values())
    assert m.tables["live"] == silver.read(spark, batch, "live").count() == m.accepted["live"]
    assert m.rejected["unrouted"] == silver.read(spark, batch, "rejects/unrouted").count() > 7
    assert silver.read(spark, batch, "documents/live").where("NOT valid").count() == m.rejected["live"] > 0


def test_rules_are_counted_on_the_way(spark, batch):
    counted = {(r.kind, r.rule, r.field): r.rejects for r in deliveries.rule_counts(spark, batch).collect()}
    rows = [silver.read(spark, batch, f"rejects/{k}").withColumn("kind", F.lit(k)) for k in ("live", "unrouted")]
    stored = rows[0].union(rows[1]).groupBy("kind", "rule", "field").count().collect()
    assert counted == {(r.kind, r.rule, r.field): r["count"] for r in stored} and len(counted) > 4


def test_stream_equals_batch(spark, feed, batch):
    location = scratch_path(spark, "stream")
    follow(spark, feed, location, scratch_path(spark, "state"))
    assert deliveries.manifests(spark, location).count() == 3
    for name in NAMES:
        assert table_rows(spark, location, name) == table_rows(spark, batch, name)
    deliveries_of = {r.delivery for r in silver.read(spark, location, "live").select("delivery").distinct().collect()}
    assert deliveries_of == {"feed-0", "feed-1", "feed-2"}


@pytest.mark.parametrize("where", ["tables", "publish", "after"])
def test_restart_in_the_middle_of_a_batch(spark, feed, batch, monkeypatch, where):
    """A batch that fails half written, unpublished, or published but not committed, is in the tables once."""
    location, state = scratch_path(spark, "stream"), scratch_path(spark, "state")
    calls, done = [], {"tables": silver._store_kind, "publish": deliveries.publish, "after": deliveries.publish}[where]

    def fail(*args):
        calls.append(args)
        if len(calls) == (4 if where == "tables" else 2):
            if where == "after":
                done(*args)
            raise RuntimeError("lost")
        return done(*args)

    with monkeypatch.context() as m:
        m.setattr(*(silver, "_store_kind") if where == "tables" else (deliveries, "publish"), fail)
        with pytest.raises(Exception, match="lost"):
            follow(spark, feed, location, state)
    shown = silver.read(spark, location, "live")
    whole = {r.delivery: r.tables["live"] for r in deliveries.manifests(spark, location).collect()}
    assert {r.delivery: r["count"] for r in shown.groupBy("delivery").count().collect()} == whole
    assert len(whole) == (2 if where == "after" else 1)
    follow(spark, feed, location, state)
    for name in NAMES:
        assert table_rows(spark, location, name) == table_rows(spark, batch, name)


def test_a_delivery_shows_as_it_was_until_its_repetition_is_published(spark, monkeypatch):
    location = scratch_path(spark, "again")
    first = lake.live_responses(lake.polls(spark, SF)).where("seq % 2 = 0")
    silver.store(first, location, "monday")
    before = table_rows(spark, location, "live")
    seen = []

    def look(*args):
        seen.append(table_rows(spark, location, "live"))
        raise RuntimeError("not yet")

    with monkeypatch.context() as m:
        m.setattr(deliveries, "publish", look)
        with pytest.raises(RuntimeError, match="not yet"):
            silver.store(first.where("seq % 4 = 0"), location, "monday")
    assert seen == [before] and table_rows(spark, location, "live") == before
    silver.store(first.where("seq % 4 = 0"), location, "monday")
    assert len(table_rows(spark, location, "live")) == first.where("seq % 4 = 0").count()
    # A repetition without a kind that was there before leaves nothing of it.
    silver.store(lake.schedule_responses(spark, SF).where("year = 1997 AND month < 4"), location, "monday")
    assert table_rows(spark, location, "live") == [] and silver.read(spark, location, "schedule").count() > 0


def test_compaction_changes_no_rows(spark, feed, batch):
    location = scratch_path(spark, "stream")
    follow(spark, feed, location, scratch_path(spark, "state"))
    with pytest.raises(ValueError, match="feed-9"):
        silver.compact(spark, location, "old", "feed-0", "feed-9")
    silver.compact(spark, location, "old", "feed-0", "feed-1")
    assert {r.delivery for r in deliveries.manifests(spark, location).collect()} == {"old", "feed-2"}
    for name in NAMES:
        assert table_rows(spark, location, name) == table_rows(spark, batch, name)
    assert deliveries.folders(spark, f"{location}/live/delivery=feed-0") == []
    (a,) = deliveries.manifests(spark, batch).agg(F.sum("responses")).first()
    assert deliveries.manifests(spark, location).agg(F.sum("responses")).first()[0] == a


def test_deep_schedules_are_stored_whole(spark, landed):
    def park(name, day, *parks, **more):
        entry = {"date": day, "type": "OPERATING", "openingTime": f"{day}T09:00:00Z", "closingTime": f"{day}T10:00:00Z"} | more
        return {"id": name, "schedule": [entry], "parks": list(parks)}

    deep = park("d", "2026-01-01", park("p", "2026-01-02", park("q", "2026-01-03", park("r", "2026-01-04"))))
    bad = park("d", "2026-02-01", park("p", "2026-02-02", park("q", "2026-02-03", park("r", "2026-02-04", type="SHUT"))))
    holes = {"id": "h", "parks": [None, {"id": "p", "parks": [7]}]}
    location = scratch_path(spark, "deep")
    silver.store(landed(*[("/entity/d/schedule", b) for b in (deep, bad, holes)], ("/entity/d/schedule", "{")), location, "one")
    rows = silver.read(spark, location, "destination_schedule").collect()
    assert sorted((r.owner_place, r.owner_id, r.date) for r in rows) == [
        ([], "d", "2026-01-01"), ([0], "p", "2026-01-02"), ([0, 0], "q", "2026-01-03"), ([0, 0, 0], "r", "2026-01-04"),
    ]
    assert [r.date for r in silver.read(spark, location, "schedule").collect()] == ["2026-01-01"]
    rejects = silver.read(spark, location, "rejects/schedule").collect()
    assert sorted((r.seq, r.rule, r.field) for r in rejects) == [
        (1, "VAL3", "parks.parks.parks.schedule.type"), (2, "VAL2", "parks"), (2, "VAL2", "parks.parks"), (3, "VAL1", "body"),
    ]
    counted = {(r.rule, r.field): r.rejects for r in deliveries.rule_counts(spark, location).collect()}
    assert counted == {(r.rule, r.field): 1 for r in rejects}
    (m,) = deliveries.manifests(spark, location).collect()
    assert (m.responses, m.accepted, m.rejected) == (4, {"schedule": 1}, {"schedule": 3})


def test_levels_parse_a_body_once(spark):
    """The bodies are parsed for the top level alone; every further level starts from stored variants."""
    levels = validate.schedule_levels(lake.deep_schedule_responses(spark, SF))
    assert "from_json" not in plan(levels.owners) and "from_json" not in plan(levels.documents)
    assert flatten.nested_schedule(levels.owners).count() == lake.openings(spark, SF).where("seq % 11 <> 0").count()


def test_a_delivery_stores_its_bodies_twice_and_shuffles_none(spark, monkeypatch):
    """bodies travel from the responses to the landed rows and from there to the documents, row by row."""
    written, done = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        if "body" in self._df.columns and self._df.count():
            written.append((path, plan(self._df)))
        return done(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    location = scratch_path(spark, "once")
    pages = lake.schedule_responses(spark, SF).where("year = 1997 AND month < 4")
    silver.store(pages, location, "all")
    assert len(written) == 2 and not any("Exchange" in shown for _, shown in written)
    assert silver.read(spark, location, "documents/schedule").count() == silver.read(spark, location, "schedule").count() == pages.count()


def test_schedules_with_parks_are_stored_once(spark):
    """Documents that wait for the levels below them leave nothing beside the valid and the broken ones."""
    location = scratch_path(spark, "late")
    silver.store(lake.deep_schedule_responses(spark, SF), location, "all")
    (folder,) = deliveries.attempt_folders(spark, location, "documents/schedule")
    assert deliveries.folders(spark, folder) == ["valid=false", "valid=true"]
    documents = silver.read(spark, location, "documents/schedule")
    assert documents.count() == lake.openings(spark, SF).count()
    assert documents.where("valid").count() == lake.openings(spark, SF).where("seq % 11 <> 0").count()
    (m,) = deliveries.manifests(spark, location).collect()
    assert m.tables["documents/schedule"] == documents.count() == m.accepted["schedule"] + m.rejected["schedule"]


def test_one_day_of_the_live_table_is_one_folder(spark):
    location = scratch_path(spark, "days")
    silver.store(lake.live_responses(lake.polls(spark, SF)), location, "all")
    day = silver.read(spark, location, "offers").where("poll_date = DATE'2024-01-15'")
    assert "poll_date" in plan(day).split("PartitionFilters: ")[1].split("\n")[0]
    assert day.count() == silver.read(spark, location, "offers").where("date(last_updated) = DATE'2024-01-15'").count() > 0


def test_scratch_is_left_empty(spark):
    files = checkpoint_dir(spark)
    before = set(deliveries.folders(spark, files))
    location = scratch_path(spark, "kept")
    silver.store(lake.deep_schedule_responses(spark, SF), location, "all")
    assert set(deliveries.folders(spark, files)) - before == {location.rpartition("/")[2]}


def test_an_entity_handle_skips_files_of_other_paths(spark):
    location = scratch_path(spark, "bronze")
    sinks.write_bronze(lake.live_responses(lake.polls(spark, SF)), location)
    from queuelake.parks import ParkLake

    shown = plan(ParkLake(bronze.read_bronze(spark, location)).entity("ent-7").live())
    assert "StringStartsWith(path,/entity/ent-7/)" in shown and "endpoint" in shown.split("PartitionFilters: ")[1].split("\n")[0]
    (part,) = spark.read.parquet(location).select("path").coalesce(1).rdd.glom().collect()
    assert len(part) == lake.polls(spark, SF).count()
    one = spark.read.parquet(*[f"{location}/endpoint=live"]).select("path", F.input_file_name().alias("f")).collect()
    by_file = {}
    for r in one:
        by_file.setdefault(r.f, []).append(r.path)
    assert all(paths == sorted(paths) for paths in by_file.values())


def test_empty_delivery(spark):
    location = scratch_path(spark, "empty")
    silver.store(spark.createDataFrame([], BRONZE), location, "none")
    for name in NAMES:
        assert silver.read(spark, location, name).count() == 0
    assert json.loads(deliveries.manifests(spark, location).toJSON().first())["responses"] == 0


def test_nested_tables_come_of_deliveries_side_by_side(spark, monkeypatch):
    """every delivery of q88 begins before the first one is through."""
    begun, done = Barrier(4), silver.store

    def store(*args):
        begun.wait(timeout=60)
        return done(*args)

    monkeypatch.setattr(silver, "store", store)
    counts = {r["table"]: r["count"] for r in QUERIES["q88_stored_nested_tables"](spark, SF).groupBy("table").count().collect()}
    orders, k = lake.table(spark, SF, "orders"), F.col("k")
    assert counts == {
        "showtimes": orders.where("o_orderkey % 2 = 0").count(),
        "operating_hours": orders.where("o_orderkey % 2 = 1").count(),
        "dining": lake.polls(spark, SF).where(k % 3 == 1).count(),
        "tags": lake.polls(spark, SF).where(k % 5 < 3).count(),
        "purchases": lake.table(spark, SF, "lineitem").count(),
    }
