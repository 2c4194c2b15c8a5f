"""Every registered query: the driver's tables, through the lake, to one answer table.

Instants leave as text so that engines with and without zones compare alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelake.functions import http, live as live_fn, paths, text, times
from queuelake.operators import (
    attempts as log,
    directory,
    flatten,
    freshness,
    geo,
    hierarchy,
    ingest,
    live,
    schedule,
)
from queuelake.plans import lake
from queuelake.session import prepare, scratch_path
from queuelake.parks import ParkLake
from queuelake.sources import bronze, colocated, deliveries, silver, sinks, validate
from queuelake.streaming import attempts as log_stream
from queuelake.streaming import live as stream

RANGE_START, RANGE_END = dt.date(1996, 12, 30), dt.date(1997, 11, 5)
PAGE_YEAR, PAGE_MONTH = 1997, 3
NOW = dt.datetime(2024, 1, 30, 23, 0, tzinfo=dt.timezone.utc)
NEEDLE = "  Blue-RING "

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        QUERIES[name] = run
        return build

    return register


def _text(instant: str | Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = lake.live_responses(lake.polls(spark, sf_dir))
    return flatten.live(validate.documents(responses, "live"))


def _descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.descendants(
        validate.documents(lake.children_responses(spark, sf_dir), "children")
    )


def _directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.destinations(
        validate.documents(lake.directory_responses(spark, sf_dir), "destinations")
    )


def _entries(spark: SparkSession, sf_dir: str, monthly: bool = True) -> DataFrame:
    responses = lake.schedule_responses(spark, sf_dir, monthly)
    return flatten.schedule(validate.documents(responses, "schedule"))


@query("q01_destinations")
def _(spark, sf_dir):
    rows = _directory(spark, sf_dir)
    return rows.select("ord", "id", "name", "slug", "external_id")


@query("q02_entities")
def _(spark, sf_dir):
    docs = validate.documents(lake.entity_responses(spark, sf_dir), "entity")
    return flatten.entities(docs).drop("path", "fetched_at", "tags")


@query("q03_walk")
def _(spark, sf_dir):
    rows = _descendants(spark, sf_dir)
    return rows.select("root_id", "seq", "ord", "id", "name", "entity_type", "parent_id")


@query("q04_live_rows")
def _(spark, sf_dir):
    rows = _live(spark, sf_dir)
    return rows.select(
        "seq", "ord", "id", "name", "entity_type", "status", _text("last_updated").alias("last_updated")
    )


@query("q05_upcoming_schedule")
def _(spark, sf_dir):
    responses = bronze.upcoming(lake.schedule_responses(spark, sf_dir, monthly=False))
    rows = flatten.schedule(validate.documents(responses, "schedule"))
    return rows.select(
        "seq",
        "ord",
        "entity_id",
        "date",
        "type",
        _text("opening_time").alias("opening_time"),
        _text("closing_time").alias("closing_time"),
    )


@query("q06_month_page")
def _(spark, sf_dir):
    pages = bronze.month_page(lake.schedule_responses(spark, sf_dir), PAGE_YEAR, PAGE_MONTH)
    rows = flatten.schedule(validate.documents(pages, "schedule"))
    return rows.select("seq", "entity_id", "year", "month", "date", "type")


@query("q07_routes")
def _(spark, sf_dir):
    routed = bronze.route(lake.traffic(spark, sf_dir))
    return routed.select("seq", "path", *bronze.ROUTE_COLUMNS)


@query("q08_encoded_paths")
def _(spark, sf_dir):
    pages = lake.table(spark, sf_dir, "pages")
    return pages.select("page_id", paths.entity_path(F.col("url")).alias("path"))


def _rejected(rule: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = validate.rejects(lake.faulty_responses(spark, sf_dir), "live")
        return found.where(F.col("rule") == rule).select("seq", "rule", "field")

    return build


query("q10_rejects_unreadable")(_rejected("VAL1"))
query("q11_rejects_required")(_rejected("VAL2"))
query("q12_rejects_domain")(_rejected("VAL3"))
query("q13_rejects_naive_instant")(_rejected("VAL4"))


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = validate.documents(lake.faulty_responses(spark, sf_dir), "live")
    return flatten.live(docs).select("seq", "id", F.col("queue.STANDBY.waitTime").alias("wait_time"))


@query("q14_null_waits_accepted")
def _(spark, sf_dir):
    return _accepted(spark, sf_dir).where(F.col("wait_time").isNull()).select("seq", "id")


@query("q15_accepted_waits")
def _(spark, sf_dir):
    return _accepted(spark, sf_dir).where(F.col("wait_time").isNotNull())


@query("q16_tags")
def _(spark, sf_dir):
    docs = validate.documents(lake.tagged_responses(spark, sf_dir), "entity")
    rows = flatten.tags(flatten.entities(docs))
    value = F.col("value")
    shown = F.coalesce(
        F.when(F.col("value_kind") == "OBJECT", F.try_variant_get(value, "$.a", "string")),
        value.cast("string"),
    )
    return rows.select("seq", "entity_id", "tag", "value_kind", shown.alias("value_text"))


@query("q20_destination_parks")
def _(spark, sf_dir):
    parks = flatten.destination_parks(_directory(spark, sf_dir))
    return parks.select("destination_id", "park_ord", "park_id", "park_name")


def _offers(rows: DataFrame) -> DataFrame:
    return live.queue_offers(rows).select(
        "seq",
        "variant_ord",
        "type",
        "wait_time",
        "state",
        _text("return_start").alias("return_start"),
        _text("return_end").alias("return_end"),
        F.col("price.amount").alias("price_amount"),
        F.col("price.currency").alias("price_currency"),
        F.col("price.formatted").alias("price_formatted"),
        "allocation_status",
        "group_start",
        "group_end",
        _text("next_allocation_time").alias("next_allocation_time"),
        "estimated_wait",
    )


@query("q21_queue_offers")
def _(spark, sf_dir):
    return _offers(_live(spark, sf_dir))


@query("q22_queue_wide")
def _(spark, sf_dir):
    wide = live.queue_wide(_live(spark, sf_dir))
    return wide.select(
        "seq",
        "id",
        "standby_wait",
        "single_rider_wait",
        "paid_standby_wait",
        "has_return_time",
        "return_state",
        "has_paid_return_time",
        "paid_return_state",
        "has_boarding_group",
        "allocation_status",
        "group_start",
        "group_end",
        "estimated_wait",
    )


@query("q23_price_labels")
def _(spark, sf_dir):
    offers = live.queue_offers(_live(spark, sf_dir)).where(F.col("type") == "PAID_RETURN_TIME")
    return offers.select("seq", "id", live_fn.price_label(F.col("price")).alias("price_label"))


def _hours(rows: DataFrame) -> DataFrame:
    return rows.select(
        "seq",
        "entity_id",
        "ord",
        "type",
        _text("start_time").alias("start_time"),
        _text("end_time").alias("end_time"),
    )


@query("q24_showtimes")
def _(spark, sf_dir):
    docs = validate.documents(lake.hours_responses(spark, sf_dir), "live")
    return _hours(flatten.showtimes(flatten.live(docs)))


@query("q25_operating_hours")
def _(spark, sf_dir):
    docs = validate.documents(lake.hours_responses(spark, sf_dir), "live")
    return _hours(flatten.operating_hours(flatten.live(docs)))


@query("q26_dining")
def _(spark, sf_dir):
    docs = validate.documents(lake.dining_responses(spark, sf_dir), "live")
    return flatten.dining(flatten.live(docs)).select("seq", "entity_id", "ord", "party_size", "wait_time")


@query("q27_purchases")
def _(spark, sf_dir):
    docs = validate.documents(lake.purchase_responses(spark, sf_dir), "schedule")
    rows = flatten.purchases(flatten.schedule(docs))
    return rows.select(
        "seq",
        "entity_id",
        "date",
        "type",
        "purchase_id",
        "purchase_name",
        F.col("price.amount").alias("amount"),
        F.col("price.currency").alias("currency"),
        "available",
    )


@query("q28_destination_schedule")
def _(spark, sf_dir):
    docs = validate.nested_schedules(lake.destination_schedule_responses(spark, sf_dir))
    rows = flatten.nested_schedule(docs)
    return rows.select("root_id", "owner_id", "seq", "date", "type")


@query("q29_locations")
def _(spark, sf_dir):
    return _descendants(spark, sf_dir).select("id", "latitude", "longitude")


@query("q30_find_one")
def _(spark, sf_dir):
    return directory.find(lake.directory(spark, sf_dir), NEEDLE)


@query("q31_find_many")
def _(spark, sf_dir):
    found = directory.find_many(lake.directory(spark, sf_dir), lake.queries_to_find(spark, sf_dir))
    return found.select("q", "ord", "slug", "name")


@query("q32_longest_waits")
def _(spark, sf_dir):
    return live.longest_waits(_live(spark, sf_dir))


@query("q33_located_by_type")
def _(spark, sf_dir):
    return geo.count_by_type(_descendants(spark, sf_dir))


@query("q34_ticketed_events")
def _(spark, sf_dir):
    rows = schedule.of_type(_entries(spark, sf_dir), "TICKETED_EVENT")
    return rows.select("seq", "entity_id", "date", "type")


@query("q35_reported_offers")
def _(spark, sf_dir):
    offers = live.reported_offers(live.queue_offers(_live(spark, sf_dir)))
    return offers.select("seq", "id", "variant_ord", "type", "wait_time")


@query("q36_located_listing")
def _(spark, sf_dir):
    return geo.listing_by_type(_descendants(spark, sf_dir))


@query("q37_live_board")
def _(spark, sf_dir):
    return live.board_by_name(_live(spark, sf_dir))


@query("q40_schedule_range")
def _(spark, sf_dir):
    rows = schedule.range_report(_entries(spark, sf_dir), RANGE_START, RANGE_END)
    return rows.select("entity_id", "date", "year", "month", "seq", "type")


@query("q41_schedule_ranges")
def _(spark, sf_dir):
    rows = schedule.ranges(lake.range_requests(spark, sf_dir), _entries(spark, sf_dir))
    return rows.select("req_id", "entity_id", "seq", "date", "type")


@query("q42_descendants")
def _(spark, sf_dir):
    return hierarchy.descendant_closure(lake.edges(spark, sf_dir))


@query("q43_fresh_hits")
def _(spark, sf_dir):
    hits = freshness.fresh_hits(
        lake.requested_traffic(spark, sf_dir), lake.stored_traffic(spark, sf_dir)
    )
    return hits.select("seq", "path", "stored_seq", _text("stored_at").alias("stored_at"))


@query("q44_range_counts")
def _(spark, sf_dir):
    return schedule.range_counts(lake.range_requests(spark, sf_dir), _entries(spark, sf_dir))


@query("q45_newest_stored")
def _(spark, sf_dir):
    newest = bronze.newest_per_path(lake.stored_traffic(spark, sf_dir))
    return newest.select("path", "seq", _text("fetched_at").alias("fetched_at"), "body")


@query("q46_newest_payload")
def _(spark, sf_dir):
    newest = bronze.newest_per_path(lake.landed_traffic(spark, sf_dir))
    return newest.select("path", "seq", _text("fetched_at").alias("fetched_at"), "body")


@query("q50_normalized_text")
def _(spark, sf_dir):
    documents = lake.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.normalize(F.col("text")).alias("normalized"))


@query("q51_current_waits")
def _(spark, sf_dir):
    return live.with_wait(_live(spark, sf_dir)).select("seq", "id", "wait")


@query("q52_instants")
def _(spark, sf_dir):
    instant = times.parse_api_datetime("v", "tz")
    return lake.date_texts(spark, sf_dir).select("ord", "v", "tz", _text(instant).alias("instant"))


@query("q53_bad_dates")
def _(spark, sf_dir):
    instant = times.parse_api_datetime("v", "tz")
    bad = lake.date_texts(spark, sf_dir).where(F.col("v").isNotNull() & instant.isNull())
    return bad.select("ord", F.concat(F.lit("invalid date: "), F.col("v")).alias("error"))


@query("q54_request_months")
def _(spark, sf_dir):
    return schedule.request_months(lake.range_requests(spark, sf_dir))


@query("q55_month_paths")
def _(spark, sf_dir):
    return ingest.month_paths(lake.range_requests(spark, sf_dir))


@query("q56_freshness_limits")
def _(spark, sf_dir):
    limit = paths.ttl_seconds(paths.endpoint(F.col("path")))
    return lake.traffic(spark, sf_dir).select("seq", "path", limit.alias("ttl"))


@query("q57_retry_after")
def _(spark, sf_dir):
    seconds = http.retry_after_seconds(F.col("retry_after"), F.col("received_at"))
    return lake.attempts(spark, sf_dir).select("seq", "retry_after", seconds.alias("seconds"))


@query("q58_backoff_bounds")
def _(spark, sf_dir):
    n = F.col("attempt")
    bounds = (http.backoff_low(n).alias("low"), http.backoff_high(n).alias("high"))
    return lake.attempts(spark, sf_dir).select("seq", "attempt", *bounds)


@query("q59_error_messages")
def _(spark, sf_dir):
    message = http.error_message(
        F.col("status"), F.col("reason"), F.col("content_type"), F.col("body")
    )
    failed = lake.attempts(spark, sf_dir).where(F.col("status") >= 300)
    return failed.select("seq", message.alias("message"))


@query("q60_json_bodies")
def _(spark, sf_dir):
    is_json = http.is_json_body(F.col("content_type"))
    return lake.attempts(spark, sf_dir).select("seq", "content_type", is_json.alias("is_json"))


@query("q61_manifest")
def _(spark, sf_dir):
    return ingest.manifest(lake.range_requests(spark, sf_dir))


@query("q62_to_fetch")
def _(spark, sf_dir):
    wanted = lake.requested_traffic(spark, sf_dir).select("path").distinct()
    return ingest.to_fetch(wanted, lake.stored_traffic(spark, sf_dir), NOW)


@query("q63_attempt_outcomes")
def _(spark, sf_dir):
    return log.classify(lake.attempts(spark, sf_dir)).select("seq", "outcome")


@query("q64_retryable")
def _(spark, sf_dir):
    return log.with_retry_rule(lake.attempts(spark, sf_dir)).select("seq", "attempt", "retryable")


@query("q65_retry_waits")
def _(spark, sf_dir):
    rows = log.with_retry_wait(lake.attempts(spark, sf_dir))
    return rows.select("seq", "retryable", "wait_low", "wait_high")


@query("q66_final_outcomes")
def _(spark, sf_dir):
    finals = log.final_outcomes(lake.attempts(spark, sf_dir), "status", "failure")
    return finals.select("request_id", "attempts", "attempt", "status", "outcome")


@query("q67_dead_letters")
def _(spark, sf_dir):
    return log.dead_letters(log.final_outcomes(lake.attempts(spark, sf_dir)))


def _board(rows: DataFrame) -> DataFrame:
    kept = live.with_wait(live.current_state(rows, "name", "status", "queue"))
    return kept.select("id", "name", "status", "wait", _text("last_updated").alias("last_updated"), "seq")


@query("q70_current_board")
def _(spark, sf_dir):
    return _board(_live(spark, sf_dir))


def current_longest_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the current board, rides reporting a wait, longest wait first."""
    rows = live.current_state(_live(prepare(spark), sf_dir), "name", "status", "queue")
    return live.longest_waits(rows).select("id", "name", "status", "wait")


QUERIES["q71_current_longest_waits"] = current_longest_waits


def _poll_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table followed as a stream of live responses."""
    return lake.live_responses(lake.live_columns(lake.event_stream(spark, sf_dir)))


@query("q72_stream_offers")
def _(spark, sf_dir):
    table, state = scratch_path(spark, "offers"), scratch_path(spark, "offers-state")
    stream.append_table(stream.offers(_poll_stream(spark, sf_dir)), table, state).awaitTermination()
    return spark.read.parquet(table).select("seq", "id", "variant_ord", "type", "wait_time")


@query("q73_stream_first_sightings")
def _(spark, sf_dir):
    table, state = scratch_path(spark, "sightings"), scratch_path(spark, "sightings-state")
    responses = _poll_stream(spark, sf_dir)
    polled_twice = responses.withColumn("poll", F.explode(F.array(F.lit(1), F.lit(2)))).drop("poll")
    rows = stream.first_sightings(stream.live_rows(polled_twice).select("id", "name", "last_updated"), "1 hour")
    stream.append_table(rows, table, state).awaitTermination()
    return spark.read.parquet(table).select("id", "name", _text("last_updated").alias("last_updated"))


@query("q74_stream_board")
def _(spark, sf_dir):
    table, state = scratch_path(spark, "board"), scratch_path(spark, "board-state")
    rows = live.with_wait(stream.live_rows(_poll_stream(spark, sf_dir)))
    stream.write_board(rows, table, state, "name", "status", "wait", buckets=8).awaitTermination()
    board = stream.read_board(spark, table)
    return board.select("id", "name", "status", "wait", _text("last_updated").alias("last_updated"), "seq")


@query("q80_stored_month_page")
def _(spark, sf_dir):
    """One month of a lake stored by endpoint, year and month: a scan of its folder."""
    location = scratch_path(spark, "bronze")
    sinks.write_bronze(lake.schedule_responses(spark, sf_dir), location)
    pages = bronze.month_page(bronze.read_bronze(spark, location), PAGE_YEAR, PAGE_MONTH)
    return flatten.schedule(validate.documents(pages, "schedule")).select("seq", "entity_id", "year", "month", "date", "type")


@query("q81_stored_offers")
def _(spark, sf_dir):
    """Offers answered from the typed live table."""
    location = scratch_path(spark, "silver")
    silver.store(lake.live_responses(lake.polls(spark, sf_dir)), location, "all")
    return _offers(silver.read(spark, location, "live"))


@query("q82_stored_rejects")
def _(spark, sf_dir):
    """Every response that a delivery did not take: what is wrong with it, from the stored rejects."""
    location = scratch_path(spark, "silver")
    silver.store(lake.faulty_responses(spark, sf_dir), location, "all")
    return silver.read(spark, location, "rejects/live").select("seq", "rule", "field")


@query("q83_stream_silver")
def _(spark, sf_dir):
    """Offers of all tables that a stream of polls keeps, a delivery per micro-batch."""
    location = scratch_path(spark, "silver")
    silver.follow(_poll_stream(spark, sf_dir), location, scratch_path(spark, "silver-state"), "polls").awaitTermination()
    rows = silver.read(spark, location, "offers")
    return rows.select("seq", "id", "variant_ord", "type", "wait_time")


@query("q84_delivery_counts")
def _(spark, sf_dir):
    """What came of every response of a delivery, by its manifest."""
    location = scratch_path(spark, "silver")
    failed = F.when(F.col("seq") % 100 == 1, 503).otherwise(F.col("status"))
    silver.store(lake.faulty_responses(spark, sf_dir).withColumn("status", failed), location, "all")
    return deliveries.counts(spark, location)


@query("q85_reject_counts")
def _(spark, sf_dir):
    """Rejects by rule and field, as counted while they were written."""
    location = scratch_path(spark, "silver")
    silver.store(lake.faulty_responses(spark, sf_dir), location, "all")
    return deliveries.rule_counts(spark, location)


@query("q86_stored_deep_schedule")
def _(spark, sf_dir):
    """Entries of stored schedules of four levels."""
    location = scratch_path(spark, "silver")
    silver.store(lake.deep_schedule_responses(spark, sf_dir), location, "all")
    rows = silver.read(spark, location, "destination_schedule")
    return rows.select("seq", "root_id", F.size("owner_place").alias("depth"), "owner_id", "date", "type")


LIVE_DAY = dt.date(2024, 1, 15)


@query("q87_stored_live_day")
def _(spark, sf_dir):
    """Waits polled on one day: a scan of that day's folder of the live table."""
    location = scratch_path(spark, "silver")
    silver.store(lake.live_responses(lake.polls(spark, sf_dir)), location, "all")
    rows = live.with_wait(silver.read(spark, location, "live").where(F.col("poll_date") == LIVE_DAY))
    return rows.select("seq", "id", "status", "wait")


@query("q88_stored_nested_tables")
def _(spark, sf_dir):
    """Rows of the tables made from lists inside live entries, entities and schedules."""
    location = scratch_path(spark, "silver")
    landed = {
        "hours": lake.hours_responses(spark, sf_dir),
        "dining": lake.dining_responses(spark, sf_dir),
        "tags": lake.tagged_responses(spark, sf_dir),
        "purchases": lake.purchase_responses(spark, sf_dir),
    }
    # Side by side: what one delivery leaves idle at the end of a step, another uses.
    with ThreadPoolExecutor(len(landed)) as pool:
        # All landed on one day, as a full listing does.
        jobs = [pool.submit(silver.store, rows.withColumn("fetched_at", F.lit(NOW)), location, name) for name, rows in landed.items()]
        for job in jobs:
            job.result()
    return (
        _hours(silver.read(spark, location, "showtimes")).select(F.lit("showtimes").alias("table"), "seq", "entity_id", F.col("start_time").alias("what"))
        .union(_hours(silver.read(spark, location, "operating_hours")).select(F.lit("operating_hours"), "seq", "entity_id", "start_time"))
        .union(silver.read(spark, location, "dining").select(F.lit("dining"), "seq", "entity_id", F.col("party_size").cast("int").cast("string")))
        .union(silver.read(spark, location, "tags").select(F.lit("tags"), "seq", "entity_id", F.concat_ws(" ", "tag", "value_kind")))
        .union(silver.read(spark, location, "purchases").select(F.lit("purchases"), "seq", "entity_id", "purchase_id"))
    )


@query("q89_entity_upcoming")
def _(spark, sf_dir):
    """One entity's schedule through its handle, from a stored lake of all entities."""
    location = scratch_path(spark, "bronze")
    sinks.write_bronze(lake.purchase_responses(spark, sf_dir), location)
    handle = ParkLake(bronze.read_bronze(spark, location)).entity("ent-7")
    return handle.schedule_between(dt.date(1992, 1, 1), dt.date(2010, 12, 31)).select("seq", "entity_id", "date", "year", "month")


@query("q90_listed_destinations")
def _(spark, sf_dir):
    """Entries of many directory documents."""
    docs = validate.documents(lake.listing_responses(spark, sf_dir), "destinations")
    return flatten.destinations(docs).select("seq", "ord", "id", "name", "slug", F.size("parks").alias("parks"))


@query("q91_listed_parks")
def _(spark, sf_dir):
    """Parks of many directory documents."""
    docs = validate.documents(lake.listing_responses(spark, sf_dir), "destinations")
    parks = flatten.destination_parks(flatten.destinations(docs))
    return parks.select("seq", "destination_id", "park_ord", "park_id", "park_name")


def _colocated(spark: SparkSession, store: Callable[..., DataFrame], rows: DataFrame) -> DataFrame:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return store(rows, f"colocated_{uuid4().hex}", scratch_path(spark, "colocated"), buckets)


@query("q92_newest_colocated")
def _(spark, sf_dir):
    """Newest response per path, from a table in buckets by path and day."""
    responses = _colocated(spark, colocated.store_responses, lake.landed_traffic(spark, sf_dir))
    newest = colocated.newest_per_path(responses)
    return newest.select("path", "seq", _text("fetched_at").alias("fetched_at"), "body")


@query("q93_colocated_ranges")
def _(spark, sf_dir):
    """Many date ranges, against a table in buckets by entity and page."""
    entries = _colocated(spark, colocated.store_entries, _entries(spark, sf_dir).drop("purchases"))
    rows = schedule.ranges(lake.range_requests(spark, sf_dir), entries)
    return rows.select("req_id", "entity_id", "seq", "date", "type")


def _followed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, state = scratch_path(spark, "outcomes"), scratch_path(spark, "outcomes-state")
    rows = log_stream.final_outcomes(lake.attempt_stream(spark, sf_dir), "1 minute", at="logged_at")
    stream.append_table(rows, table, state).awaitTermination()
    return spark.read.parquet(table)


@query("q94_stream_outcomes")
def _(spark, sf_dir):
    """How requests ended, from the attempt log followed as a stream."""
    return _followed_outcomes(spark, sf_dir).select("request_id", "attempts", "attempt", "status", "outcome")


@query("q95_stream_dead_letters")
def _(spark, sf_dir):
    """Requests that failed for good, from the attempt log followed as a stream."""
    return log_stream.dead_letters(_followed_outcomes(spark, sf_dir))


@query("q96_landed_successes")
def _(spark, sf_dir):
    """Responses that reach the lake from the attempt log."""
    rows = log.landed(lake.attempts(spark, sf_dir))
    return rows.select("seq", "path", _text("fetched_at").alias("fetched_at"), "status", "content_type", "body")


@query("q97_strict_dates")
def _(spark, sf_dir):
    """Instants of date texts that are known to be good, read so that a bad one would fail the query."""
    good = lake.date_texts(spark, sf_dir).where(~F.col("v").endswith("bad"))
    return good.select("ord", _text(times.parse_api_datetime("v", "tz", strict=True)).alias("instant"))
