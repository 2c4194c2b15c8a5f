"""Stored lakes, pruning, and the shape of the plans."""

import datetime as dt
import io
from contextlib import redirect_stdout
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from queuelake.operators import flatten, live, schedule
from queuelake.plans import lake
from queuelake.plans.queries import QUERIES
from queuelake.session import scratch_path
from queuelake.sources import bronze, silver, sinks, validate

SF = "/root/testdata/sf0.001"


def plan(frame):
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    location = scratch_path(spark, "bronze")
    sinks.write_bronze(lake.schedule_responses(spark, SF), location)
    sinks.write_bronze(lake.live_responses(lake.polls(spark, SF)), location)
    return location


def test_lake_round_trip_prunes_folders(spark, stored):
    responses = bronze.read_bronze(spark, stored)
    page = bronze.month_page(responses, 1997, 3)
    shown = plan(page.select("seq"))
    assert "PartitionFilters" in shown and "year" in shown.split("PartitionFilters")[1][:400]
    expected = bronze.month_page(lake.schedule_responses(spark, SF), 1997, 3)
    assert page.count() == expected.count() > 0
    entries = flatten.schedule(validate.documents(responses, "schedule"))
    wanted = schedule.entries_between(entries, dt.date(1996, 12, 30), dt.date(1997, 11, 5))
    filters = plan(wanted).split("PartitionFilters")[1].split("\n")[0]
    assert "endpoint" in filters and "year" in filters and "month" in filters
    assert wanted.count() == QUERIES["q40_schedule_range"](spark, SF).count()


def test_live_rows_from_the_stored_lake(spark, stored):
    rows = flatten.live(validate.documents(bronze.read_bronze(spark, stored), "live"))
    assert rows.count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_json_lines_lake(spark):
    location = scratch_path(spark, "json")
    responses = lake.live_responses(lake.polls(spark, SF)).drop("endpoint", "entity_id", "year", "month")
    responses.write.json(location)
    rows = flatten.live(validate.documents(bronze.read_bronze(spark, location, "json"), "live"))
    assert rows.select("seq").distinct().count() == responses.count()


def test_checked_documents_split_on_disk(spark):
    location = scratch_path(spark, "checked")
    faulty = lake.faulty_responses(spark, SF)
    sinks.write_checked(faulty, "live", location)
    checked = sinks.read_checked(spark, location)
    valid, rejected = validate.split(faulty, "live")
    assert checked.where("valid").count() == valid.count()
    assert checked.where("NOT valid").count() == rejected.select("seq").distinct().count()
    assert valid.count() + rejected.select("seq").distinct().count() == faulty.count()


def test_typed_table(spark):
    location = scratch_path(spark, "typed")
    rows = flatten.schedule(validate.documents(lake.schedule_responses(spark, SF), "schedule"))
    sinks.write_table(rows, location, ("year", "month"))
    assert spark.read.parquet(location).count() == rows.count()


def test_columns_of_many_values_give_up_their_dictionary(spark):
    """no value is looked up among thousands of others as it is written; few values are still written once."""
    location = scratch_path(spark, "dictionaries")
    rows = spark.range(40_000, numPartitions=1).selectExpr("concat('entity-', id % 8000) AS id", "concat('kind-', id % 50) AS kind", "id % 2 AS half")
    sinks.write_table(rows, location, ("half",))
    shown = {}
    for file in Path(location.removeprefix("file:")).glob("half=*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for i in range(meta.num_columns):
            column = meta.row_group(0).column(i)
            shown.setdefault(column.path_in_schema, set()).add(column.has_dictionary_page)
    assert shown == {"id": {False}, "kind": {True}}
    assert spark.read.parquet(location).exceptAll(rows.selectExpr("id", "kind", "CAST(half AS INT)")).isEmpty()


@pytest.fixture(scope="module")
def tables(spark, stored):
    location = scratch_path(spark, "silver")
    faulty = lake.faulty_responses(spark, SF).select(*bronze.read_bronze(spark, stored).columns, "entity_id")
    responses = bronze.route(bronze.read_bronze(spark, stored)).unionByName(faulty)
    for _ in range(2):  # a repeated delivery replaces itself
        silver.store(responses, location, "2026-04-14")
    return location


def test_silver_tables(spark, tables):
    faulty = lake.faulty_responses(spark, SF)
    polls = spark.read.parquet(f"{SF}/events.parquet").count()
    good = validate.documents(faulty, "live").count()
    rows = spark.read.parquet(f"{tables}/live")
    assert rows.count() == polls + good
    assert spark.read.parquet(f"{tables}/schedule").count() == lake.table(spark, SF, "orders").count()
    assert spark.read.parquet(f"{tables}/rejects/live").count() == polls - good
    assert {r.delivery.isoformat() for r in rows.select("delivery").distinct().collect()} == {"2026-04-14"}


def test_board_over_silver_reads_one_queue_field(spark, tables):
    shown = plan(live.with_wait(spark.read.parquet(f"{tables}/live")).select("name", "wait"))
    read = shown.split("ReadSchema: ")[1].split("\n")[0]
    assert read == "struct<name:string,queue:struct<STANDBY:struct<waitTime:double>>>"


def test_ranges_over_silver_prune_to_the_months_asked_for(spark, tables):
    entries = spark.read.parquet(f"{tables}/schedule")
    asked = lake.range_requests(spark, SF).where(F.col("req_id") < 5)
    joined = schedule.ranges(asked, entries)
    assert "dynamicpruning" in plan(joined)
    assert joined.count() == schedule.ranges(asked, flatten.schedule(
        validate.documents(lake.schedule_responses(spark, SF), "schedule"))).count()


def test_body_is_parsed_once_and_unpivoted_in_one_step(spark, stored):
    responses = bronze.read_bronze(spark, stored)
    offers = live.queue_offers(flatten.live(validate.documents(responses, "live")))
    shown = plan(offers)
    assert shown.count("from_json(") == 1
    assert shown.split("(1) ")[0].count("Generate") == 4  # body, entries, typed queue, offers
    assert "Union" not in shown


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("q7") or n in ("q70_current_board",)])
def test_no_python_and_no_nested_loops(spark, name):
    shown = plan(QUERIES[name](spark, SF))
    for bad in ("Python", "Pandas", "NestedLoop", "CartesianProduct", "BatchEval"):
        assert bad not in shown


def test_scans_read_only_what_they_need(spark):
    for name, schema in {
        "q42_descendants": None,
        "q50_normalized_text": "struct<doc_id:bigint,text:string>",
        "q31_find_many": "struct<p_partkey:bigint,p_name:string,p_brand:string>",
        "q08_encoded_paths": "struct<page_id:bigint,url:string>",
    }.items():
        if schema:
            assert schema in plan(QUERIES[name](spark, SF))


def test_filters_reach_the_scan(spark):
    found = QUERIES["q30_find_one"](spark, SF)
    assert "TakeOrderedAndProject" in plan(found)
    assert "PushedFilters: []" not in plan(
        lake.table(spark, SF, "orders").where(F.col("o_orderkey") < 5)
    )
