"""Live boards and queue offers over typed live rows (`queuelake.operators.flatten.live`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelake.functions.live import current_wait_time, price_label
from queuelake.schemas import QUEUE_VARIANTS, WAIT_VARIANTS

_ENTRY = ("seq", "ord", "id", "name")


def _offer(position: int, variant: str) -> Column:
    """One variant of a row's queue in the shape all variants share; null when the variant is absent."""
    queue = F.col("queue")[variant]

    def field(name: str, kind: str, of: Column | None = None) -> Column:
        return (F.lit(None) if of is None else of).cast(kind).alias(name)

    is_wait = variant in WAIT_VARIANTS
    is_return = variant in ("RETURN_TIME", "PAID_RETURN_TIME")
    is_paid = variant == "PAID_RETURN_TIME"
    is_group = variant == "BOARDING_GROUP"
    shape = F.struct(
        F.lit(position).alias("variant_ord"),
        F.lit(variant).alias("type"),
        field("wait_time", "double", queue["waitTime"] if is_wait else None),
        field("state", "string", queue["state"] if is_return else None),
        field("return_start", "timestamp", queue["returnStart"] if is_return else None),
        field("return_end", "timestamp", queue["returnEnd"] if is_return else None),
        field(
            "price",
            "struct<amount:double,currency:string,formatted:string>",
            queue["price"] if is_paid else None,
        ),
        field("allocation_status", "string", queue["allocationStatus"] if is_group else None),
        field("group_start", "double", queue["currentGroupStart"] if is_group else None),
        field("group_end", "double", queue["currentGroupEnd"] if is_group else None),
        field("next_allocation_time", "timestamp", queue["nextAllocationTime"] if is_group else None),
        field("estimated_wait", "double", queue["estimatedWait"] if is_group else None),
    )
    return F.when(queue.isNotNull(), shape)


def _once(rows: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """Rows with `value` computed once each. A filter on a plain projection is pushed below it and works
    the value out a second time; the output of a generator is only read."""
    return rows.select(*keep, F.explode(F.array(value)).alias(name))


def _with_queue(live_rows: DataFrame, *keep: str) -> DataFrame:
    return _once(live_rows, "queue", F.col("queue"), *keep).where(F.col("queue").isNotNull())


def queue_offers(live_rows: DataFrame) -> DataFrame:
    """One row per queue variant an entry offers, in the fixed variant order.

    A variant that is there with only null fields is an offer; one that is null or missing is not.
    """
    keep = [c for c in (*_ENTRY, "last_updated", "poll_date") if c in live_rows.columns]
    offers = F.array(*[_offer(i + 1, v) for i, v in enumerate(QUEUE_VARIANTS)])
    rows = _with_queue(live_rows, *keep).select(*keep, F.explode(offers).alias("_o"))
    return rows.where(F.col("_o").isNotNull()).select(*keep, "_o.*")


def reported_offers(offers: DataFrame) -> DataFrame:
    """Offers worth showing: wait variants need a wait, the others only have to be there."""
    return offers.where(~F.col("type").isin(*WAIT_VARIANTS) | F.col("wait_time").isNotNull())


def queue_wide(live_rows: DataFrame) -> DataFrame:
    """One row per entry that has a queue, one column per variant field, with the price label."""
    q = F.col("queue")
    paid, group = q["PAID_RETURN_TIME"], q["BOARDING_GROUP"]
    return _with_queue(live_rows, *_ENTRY).select(
        *_ENTRY,
        q["STANDBY"]["waitTime"].alias("standby_wait"),
        q["SINGLE_RIDER"]["waitTime"].alias("single_rider_wait"),
        q["PAID_STANDBY"]["waitTime"].alias("paid_standby_wait"),
        q["RETURN_TIME"].isNotNull().alias("has_return_time"),
        q["RETURN_TIME"]["state"].alias("return_state"),
        q["RETURN_TIME"]["returnStart"].alias("return_start"),
        q["RETURN_TIME"]["returnEnd"].alias("return_end"),
        paid.isNotNull().alias("has_paid_return_time"),
        paid["state"].alias("paid_return_state"),
        paid["returnStart"].alias("paid_return_start"),
        paid["returnEnd"].alias("paid_return_end"),
        F.when(paid.isNotNull(), price_label(paid["price"])).alias("paid_return_price"),
        group.isNotNull().alias("has_boarding_group"),
        group["allocationStatus"].alias("allocation_status"),
        group["currentGroupStart"].alias("group_start"),
        group["currentGroupEnd"].alias("group_end"),
        group["nextAllocationTime"].alias("next_allocation_time"),
        group["estimatedWait"].alias("estimated_wait"),
    )


def with_wait(live_rows: DataFrame) -> DataFrame:
    """Add the current standby wait in whole minutes."""
    return _once(live_rows, "wait", current_wait_time(F.col("queue")), *live_rows.columns)


def board_by_name(live_rows: DataFrame) -> DataFrame:
    """Every entry with its wait, by name; entries without a wait stay on the board."""
    return with_wait(live_rows).orderBy("name", "seq", "ord").select(*_ENTRY, "status", "wait")


def longest_waits(live_rows: DataFrame) -> DataFrame:
    """Entries that report a wait, longest first; equal waits keep payload order."""
    waiting = with_wait(live_rows).where(F.col("wait").isNotNull())
    return waiting.orderBy(F.desc("wait"), "seq", "ord").select(*_ENTRY, "status", "wait")


def current_state(live_rows: DataFrame, *columns: str) -> DataFrame:
    """Newest live row per entity: latest `last_updated`, then the later response, then position.

    A max over structs combines before the shuffle, so an entity polled far more than others costs its
    task one row per map task. Name only the columns needed; they travel with the aggregate.
    """
    keep = columns or tuple(c for c in live_rows.columns if c not in ("id", "last_updated", "seq", "ord"))
    row = F.struct("last_updated", "seq", "ord", *keep)
    newest = F.max_by(row, F.struct("last_updated", "seq", "ord"))
    return live_rows.groupBy("id").agg(newest.alias("_n")).select("id", "_n.*")
