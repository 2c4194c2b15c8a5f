"""A lake of landed responses made from the driver's tables.

Each function nests flat rows into the payloads the data source would have served, as JSON bodies, so
that the queries run the whole way: body, checks, flattening, question. Bodies are made row by row;
only the children documents and the directory gather rows, in groups whose size is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelake.functions import paths
from queuelake.session import scratch_path

# Children per document: customers share a document by blocks of their unique key.
_CHILD_BLOCK = 1024

# Rows of a file that a stream is followed by.
_FILE_ROWS = 20_000

# Zone of every region's parks.
_ZONES = ("Africa/Johannesburg", "America/New_York", "Asia/Tokyo", "Europe/Paris", "Asia/Dubai")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read as it lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _followed(parts: list[DataFrame], rows: int, name: str) -> DataFrame:
    """Parts of a table as a stream, a micro-batch each, in their order. The `rows` of all parts lie in as many files as
    they ask, so a batch is the work of many tasks; every part has the same number of files, some of them empty if need be."""
    spark, schema = parts[0].sparkSession, parts[0].schema
    location = scratch_path(spark, name)
    files = max(1, -(-rows // (len(parts) * _FILE_ROWS)))
    for number, part in enumerate(parts, 1):
        part.repartition(files).write.mode("append").parquet(location)
        missing = number * files - len(spark.read.schema(schema).parquet(location).inputFiles())
        for _ in range(missing):
            part.limit(0).coalesce(1).write.mode("append").parquet(location)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).parquet(location)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table followed as a stream of three micro-batches, earlier events first."""
    events = table(spark, sf_dir, "events")
    micros = events.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    early, late = micros.approxQuantile("at", [1 / 3, 2 / 3], 0.01) or (0.0, 0.0)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    parts = [events.where(part) for part in (at <= early, (at > early) & (at <= late), at > late)]
    return _followed(parts, events.count(), "events")


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Region or nation, which have 5 and 25 rows at every scale."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tagged(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _utc(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _pick(number: Column, names: tuple[str, ...]) -> Column:
    """Name by remainder of `number`; the last name takes the rest."""
    chosen = F.lit(names[-1])
    for i, name in reversed(list(enumerate(names[:-1]))):
        chosen = F.when(number % len(names) == i, name).otherwise(chosen)
    return chosen


def entity_type(key: Column) -> Column:
    return _pick(key, ("ATTRACTION", "RESTAURANT", "HOTEL", "SHOW"))


def _body(document: Column, seq: Column) -> Column:
    """JSON text; nulls are left out of even documents and written as null in odd ones."""
    return F.when(seq % 2 == 0, F.to_json(document)).otherwise(
        F.to_json(document, {"ignoreNullFields": "false"})
    )


def _response(
    rows: DataFrame,
    kind: str,
    entity_id: Column | None,
    fetched_at: Column,
    body: Column,
    page: Column | None = None,
) -> DataFrame:
    """Landed responses with the routing columns a stored lake is partitioned by."""
    nothing = F.lit(None)
    owner = nothing.cast("string") if entity_id is None else entity_id
    if kind == "destinations":
        path = F.lit("/destinations")
    elif page is not None:
        path = paths.month_path(owner, F.year(page), F.month(page))
    elif kind == "entity":
        path = paths.entity_path(owner)
    else:
        path = F.concat(paths.entity_path(owner), F.lit(f"/{kind}"))
    return rows.select(
        "seq",
        path.alias("path"),
        fetched_at.cast("timestamp").alias("fetched_at"),
        F.lit(200).alias("status"),
        F.lit("application/json").alias("content_type"),
        body.alias("body"),
        F.lit(kind).alias("endpoint"),
        owner.alias("entity_id"),
        (nothing.cast("int") if page is None else F.year(page)).alias("year"),
        (nothing.cast("int") if page is None else F.month(page)).alias("month"),
    )


def _epoch() -> Column:
    return F.lit("2024-01-01 00:00:00")


def directory_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One directory document. Region and nation have a fixed number of rows at every scale."""
    region, nation = dimension(spark, sf_dir, "region"), dimension(spark, sf_dir, "nation")
    parks = nation.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("n_nationkey").alias("ord"),
                    _tagged("park-", "n_nationkey").alias("id"),
                    F.col("n_name").alias("name"),
                )
            )
        ).alias("parks")
    )
    key = F.col("r_regionkey")
    entry = F.struct(
        key.alias("ord"),
        _tagged("dest-", "r_regionkey").alias("id"),
        F.concat("r_name", F.lit(" Resort")).alias("name"),
        F.lower(F.replace("r_name", F.lit(" "), F.lit("-"))).alias("slug"),
        F.when(key % 2 == 0, _tagged("x", "r_regionkey")).alias("externalId"),
        F.col("parks"),
    )
    listing = region.join(parks, "r_regionkey", "left").agg(
        F.array_sort(F.collect_list(entry)).alias("destinations")
    )
    rows = listing.select(F.lit(0).cast("bigint").alias("seq"), "destinations")
    return _response(rows, "destinations", None, _epoch(), F.to_json(F.struct("destinations")))


def listing_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory documents of parts: one per block of their unique key, brands as destinations, parts as their parks."""
    key = F.col("p_partkey")
    block = F.floor(key / _CHILD_BLOCK).cast("bigint")
    park = F.struct(key.alias("ord"), _tagged("park-", "p_partkey").alias("id"), F.col("p_name").alias("name"))
    rows = table(spark, sf_dir, "part").select(block.alias("seq"), "p_brand", park.alias("park"))
    brands = rows.groupBy("seq", "p_brand").agg(F.array_sort(F.collect_list("park")).alias("parks"))
    entry = F.struct(
        F.col("p_brand").alias("id"),
        F.concat("p_brand", F.lit(" Resort")).alias("name"),
        F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))).alias("slug"),
        F.col("parks"),
    )
    listing = brands.groupBy("seq").agg(F.array_sort(F.collect_list(entry)).alias("destinations"))
    return _response(listing, "destinations", None, _epoch(), _body(F.struct("destinations"), F.col("seq")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities: one per customer, below the park of its nation."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("seq"),
        "c_nationkey",
        _tagged("ent-", "c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        entity_type(key).alias("entityType"),
        _tagged("park-", "c_nationkey").alias("parentId"),
        F.struct(
            F.when((key % 11 != 0) & (key % 7 != 0), F.col("c_acctbal") / 128).alias("latitude"),
            F.when(key % 11 != 0, F.col("c_acctbal") / 64 - 90).alias("longitude"),
        ).alias("location"),
    )


def entity_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = dimension(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"),
        _tagged("dest-", "n_regionkey").alias("destinationId"),
        _pick(F.col("n_regionkey"), _ZONES).alias("timezone"),
    )
    rows = customers(spark, sf_dir).join(nation, "c_nationkey")
    document = F.struct(
        "id", "name", "entityType", "parentId", "destinationId", "timezone", "location"
    )
    return _response(rows, "entity", F.col("id"), _epoch(), _body(document, F.col("seq")))


def children_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children documents: a park's entities, one document per block of customer keys."""
    rows = customers(spark, sf_dir).withColumn(
        "block", F.floor(F.col("seq") / _CHILD_BLOCK).cast("bigint")
    )
    child = F.struct(
        F.col("seq").alias("ord"), "id", "name", "entityType", "parentId", "location"
    )
    blocks = rows.groupBy("block", "c_nationkey", "parentId").agg(
        F.array_sort(F.collect_list(child)).alias("children")
    )
    blocks = blocks.withColumns({"seq": F.col("block"), "id": F.col("parentId")})
    document = F.struct("id", F.lit("PARK").alias("entityType"), "children")
    return _response(blocks, "children", F.col("id"), _epoch(), _body(document, F.col("seq")))


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as polls of one ride each; `k` is the number inside `props`, extracted once per row."""
    return live_columns(table(spark, sf_dir, "events"))


def live_columns(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("seq"),
        _tagged("ent-", "user_id").alias("id"),
        _tagged("Ride ", "user_id").alias("name"),
        entity_type(F.col("user_id")).alias("entityType"),
        F.when(kind == "purchase", "DOWN")
        .when(kind == "signup", "CLOSED")
        .when(kind == "error", "REFURBISHMENT")
        .otherwise("OPERATING")
        .alias("status"),
        F.col("ts"),
        F.col("value"),
        F.explode(F.array(F.regexp_extract("props", "([0-9]+)", 1).cast("int"))).alias("k"),
    )


def _queue() -> Column:
    """The queue record of a poll: which variants are there, and with what, follows from `k`."""
    k, value = F.col("k"), F.col("value")
    start, end = _utc(F.col("ts")), _utc(F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    price = F.struct(
        value.alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(k % 2 == 0, F.concat(F.lit("$"), k.cast("string"))).alias("formatted"),
    )
    slots = [start.alias("returnStart"), end.alias("returnEnd")]
    free_state = (
        F.when(k % 4 == 0, "AVAILABLE").when(k % 4 == 1, "TEMP_FULL").when(k % 4 == 2, "FINISHED")
    )
    group_state = F.when(k % 2 == 0, "AVAILABLE").otherwise("PAUSED")
    variants = {
        "STANDBY": (2, [F.when(k % 10 != 0, value).alias("waitTime")]),
        "SINGLE_RIDER": (3, [(value / 2).alias("waitTime")]),
        "RETURN_TIME": (5, [free_state.alias("state"), *slots]),
        "PAID_RETURN_TIME": (
            7,
            [F.lit("AVAILABLE").alias("state"), *slots, F.when(k % 3 != 0, price).alias("price")],
        ),
        "BOARDING_GROUP": (
            11,
            [
                group_state.alias("allocationStatus"),
                k.cast("double").alias("currentGroupStart"),
                (k + 10).cast("double").alias("currentGroupEnd"),
                end.alias("nextAllocationTime"),
                F.when(k % 3 == 0, value).alias("estimatedWait"),
            ],
        ),
        "PAID_STANDBY": (13, [(value / 4).alias("waitTime")]),
    }
    return F.struct(
        *[F.when(k % every == 0, F.struct(*fields)).alias(v) for v, (every, fields) in variants.items()]
    )


def _live_document(*extra: Column) -> Column:
    entry = F.struct(
        "id",
        "name",
        "entityType",
        "status",
        _utc(F.col("ts")).alias("lastUpdated"),
        *(extra or (_queue().alias("queue"),)),
    )
    return F.struct(
        F.col("id"), F.col("name"), F.col("entityType"), F.lit("UTC").alias("timezone"), F.array(entry).alias("liveData")
    )


def live_responses(polled: DataFrame) -> DataFrame:
    """Live documents of polls (`polls` or a stream of them)."""
    return _response(polled, "live", F.col("id"), F.col("ts"), _body(_live_document(), F.col("seq")))


def dining_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    seats = F.struct(
        F.when(k % 9 != 0, (k % 8 + 1).cast("double")).alias("partySize"),
        F.when(k % 4 != 0, F.col("value")).alias("waitTime"),
    )
    document = _live_document(F.when(k % 3 == 1, F.array(seats)).alias("diningAvailability"))
    rows = polls(spark, sf_dir)
    return _response(rows, "live", F.col("id"), F.col("ts"), _body(document, F.col("seq")))


def faulty_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live documents, a third of which each break one rule, by `k`."""
    k = F.col("k") % 12
    instant = _utc(F.col("ts"))
    wait = F.when(k == 4, F.lit("30")).when(k != 5, F.col("value").cast("string"))
    entry = F.struct(
        "id",
        F.when(k != 1, F.col("name")).alias("name"),
        "entityType",
        F.when(k == 2, "OPEN").otherwise(F.col("status")).alias("status"),
        F.when(k == 3, F.left(instant, F.length(instant) - 1)).otherwise(instant).alias("lastUpdated"),
        F.struct(F.struct(wait.alias("waitTime")).alias("STANDBY")).alias("queue"),
    )
    whole = _body(F.struct("id", F.array(entry).alias("liveData")), F.col("seq"))
    body = F.when(k == 0, F.left(whole, F.floor(F.length(whole) / 2).cast("int"))).otherwise(whole)
    return _response(polls(spark, sf_dir), "live", F.col("id"), F.col("ts"), body)


def tagged_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity documents with one tag whose value is text, number or object."""
    k = F.col("k")
    rows = polls(spark, sf_dir)
    text = k.cast("string")
    value = (
        F.when(k % 3 == 0, F.concat(F.lit('"'), text, F.lit('"')))
        .when(k % 3 == 1, text)
        .otherwise(F.concat(F.lit('{"a":'), text, F.lit("}")))
    )
    head = F.to_json(F.struct("id", "name", "entityType", F.lit("UTC").alias("timezone")))
    tag = F.concat(
        F.lit('[{"tag":"tag'), (k % 4).cast("string"), F.lit('","tagName":"Tag","value":'), value, F.lit("}]")
    )
    tags = F.when(k % 5 < 3, tag).otherwise(F.lit("[]"))
    body = F.concat(F.expr("left(b, length(b) - 1)"), F.lit(',"tags":'), F.col("t"), F.lit("}"))
    rows = rows.select("seq", "id", "ts", head.alias("b"), tags.alias("t"))
    return _response(rows, "entity", F.col("id"), F.col("ts"), body)


_PRIORITIES = {"1": "OPERATING", "2": "TICKETED_EVENT", "3": "PRIVATE_EVENT", "4": "EXTRA_HOURS"}


def openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as schedule entries of the ordering customer's entity."""
    priority = F.substring("o_orderpriority", 1, 1)
    kind = F.lit("INFO")
    for digit, name in _PRIORITIES.items():
        kind = F.when(priority == digit, name).otherwise(kind)
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey"),
        _tagged("ent-", "o_custkey").alias("id"),
        day.alias("ts"),
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        kind.alias("type"),
        _utc(day + F.expr("INTERVAL 9 HOUR")).alias("openingTime"),
        _utc(day + F.expr("INTERVAL 21 HOUR")).alias("closingTime"),
    )


_ENTRY = ("date", "type", "openingTime", "closingTime")


def schedule_responses(spark: SparkSession, sf_dir: str, monthly: bool = True) -> DataFrame:
    """Schedule documents, as month pages or as the upcoming schedule."""
    rows = openings(spark, sf_dir)
    day = F.col("ts")
    document = F.struct("id", F.array(F.struct(*_ENTRY)).alias("schedule"))
    body = _body(document, F.col("seq"))
    return _response(rows, "schedule", F.col("id"), day, body, day if monthly else None)


def hours_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live documents with showtimes (even keys) or operating hours (odd keys)."""
    seq = F.col("seq")
    hours = F.array(
        F.struct(
            F.col("type"),
            F.col("openingTime").alias("startTime"),
            F.when(seq % 5 != 0, F.col("closingTime")).alias("endTime"),
        )
    )
    rows = openings(spark, sf_dir).withColumns(
        {
            "name": F.concat(F.lit("Show "), F.col("id")),
            "entityType": F.lit("SHOW"),
            "status": F.lit("OPERATING"),
        }
    )
    document = _live_document(
        F.when(seq % 2 == 0, hours).alias("showtimes"),
        F.when(seq % 2 == 1, hours).alias("operatingHours"),
    )
    return _response(rows, "live", F.col("id"), F.col("ts"), _body(document, seq))


def purchase_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month pages whose entries carry one purchase each, one document per line item."""
    flag = F.col("l_returnflag")
    item = F.struct(
        F.when(flag == "A", "ADMISSION").when(flag == "N", "PACKAGE").otherwise("ATTRACTION").alias("type"),
        F.concat_ws("-", F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")).alias("id"),
        F.col("l_quantity").cast("string").alias("name"),
        F.struct(F.col("l_extendedprice").alias("amount"), F.lit("USD").alias("currency")).alias("price"),
        (F.col("l_linestatus") == "O").alias("available"),
    )
    day = F.col("l_shipdate")
    entry = F.struct(
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        F.lit("TICKETED_EVENT").alias("type"),
        _utc(day).alias("openingTime"),
        _utc(day).alias("closingTime"),
        F.array(item).alias("purchases"),
    )
    rows = table(spark, sf_dir, "lineitem").withColumn("seq", F.col("l_orderkey"))
    owner = _tagged("ent-", "l_orderkey")
    document = F.struct(owner.alias("id"), F.array(entry).alias("schedule"))
    return _response(rows, "schedule", owner, day, _body(document, F.col("l_linenumber")), day)


def destination_schedule_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destination schedules: every tenth entry is the destination's own, the rest sit below a park."""
    nation = dimension(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    home = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    rows = (
        openings(spark, sf_dir)
        .join(home, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, "n_nationkey")
    )
    entries = F.array(F.struct(*_ENTRY))
    own = F.col("seq") % 10 == 0
    park = F.struct(
        _tagged("park-", "n_nationkey").alias("id"),
        F.lit("PARK").alias("entityType"),
        entries.alias("schedule"),
    )
    document = F.struct(
        _tagged("dest-", "n_regionkey").alias("id"),
        F.when(own, entries).alias("schedule"),
        F.when(~own, F.array(park)).alias("parks"),
    )
    root = _tagged("dest-", "n_regionkey")
    return _response(rows, "schedule", root, F.col("ts"), _body(document, F.col("seq")))


def deep_schedule_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedules of four levels: the entry of an order sits one to four levels down, by its key; the levels above have
    none. Every eleventh has a bad entry at its lowest level."""
    rows = openings(spark, sf_dir)
    seq = F.col("seq")
    kind = F.when(seq % 11 == 0, "SHUT").otherwise(F.col("type"))
    entries = F.array(F.struct("date", kind.alias("type"), "openingTime", "closingTime"))
    names = ("dest-", "land-", "park-", "area-")

    def level(depth: int) -> Column:
        fields = [_tagged(names[depth], "o_custkey").alias("id"), F.when(seq % 4 == depth, entries).alias("schedule")]
        if depth + 1 < len(names):
            fields.append(F.when(seq % 4 > depth, F.array(level(depth + 1))).alias("parks"))
        return F.struct(*fields)

    root = _tagged("dest-", "o_custkey")
    return _response(rows, "schedule", root, F.col("ts"), _body(level(0), seq))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent links of destinations, parks and entities."""
    none = F.lit(None).cast("string")
    destinations = dimension(spark, sf_dir, "region").select(
        _tagged("dest-", "r_regionkey").alias("id"), none.alias("parent_id")
    )
    parks = dimension(spark, sf_dir, "nation").select(
        _tagged("park-", "n_nationkey").alias("id"), _tagged("dest-", "n_regionkey").alias("parent_id")
    )
    entities = table(spark, sf_dir, "customer").select(
        _tagged("ent-", "c_custkey").alias("id"), _tagged("park-", "c_nationkey").alias("parent_id")
    )
    return destinations.unionByName(parks).unionByName(entities)


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a large directory to look names up in."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ord"), F.lower("p_brand").alias("slug"), F.col("p_name").alias("name")
    )


def queries_to_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct part name, spelled differently, and a few queries that match many rows or none."""
    spelled = table(spark, sf_dir, "part").select(
        F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("q")
    )
    extra = spark.sql("SELECT * FROM VALUES ('Brand 12'), ('ring'), ('nowhere'), ('  '), ('!?') AS t(q)")
    return spelled.distinct().unionByName(extra)


def range_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date range per customer; every ninth is reversed."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("req_id"),
        _tagged("ent-", "c_custkey").alias("entity_id"),
        F.when(key % 9 == 0, "1999-01-01").otherwise("1996-12-30").alias("start_date"),
        F.lit("1997-11-05").alias("end_date"),
    )


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date texts with an offset, with Z, naive, and bad, next to a zone."""
    key = F.col("o_orderkey")
    tail = (
        F.when(key % 4 == 0, "T09:00:00-04:00")
        .when(key % 4 == 1, "T09:00:00Z")
        .when(key % 4 == 2, "T09:00:00")
        .otherwise(" bad")
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("ord"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), tail).alias("v"),
        _pick(F.col("o_custkey"), ("America/New_York", "Asia/Tokyo", "Europe/Paris")).alias("tz"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt log: up to four attempts per request, with outcomes by `k`."""
    k, seq = F.col("k"), F.col("seq")
    digit, forty, third = k % 10, k % 40, k % 3
    status = (
        F.when(digit == 0, 429).when(digit == 1, 502).when(digit == 2, 404).when(digit >= 5, 200)
    )
    reason = (
        F.when(digit == 0, "Too Many Requests")
        .when(digit == 1, "Bad Gateway")
        .when(digit == 2, "Not Found")
        .when(digit >= 5, "OK")
    )
    later = F.col("ts").cast("timestamp") + F.expr("INTERVAL 90 SECONDS")
    hint = (
        F.when(forty == 0, "3")
        .when(forty == 10, "-2")
        .when(forty == 20, "whenever suits")
        .when(forty == 30, F.concat(F.date_format(later, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
    )
    body = (
        F.when(third == 0, '{"error":"no such ride"}')
        .when(third == 1, F.repeat(F.lit("x"), F.lit(150) + k))
        .otherwise("")
    )
    return polls(spark, sf_dir).select(
        seq,
        F.floor(seq / 4).cast("bigint").alias("request_id"),
        (seq % 4).cast("int").alias("attempt"),
        F.concat(F.lit("/entity/"), F.col("id")).alias("url"),
        F.col("ts").cast("timestamp").alias("received_at"),
        status.alias("status"),
        reason.alias("reason"),
        F.when(digit == 3, "timeout").when(digit == 4, "network").alias("failure"),
        hint.alias("retry_after"),
        F.when(third == 0, "application/json")
        .when(third == 1, "text/plain")
        .otherwise("application/json; charset=utf-8")
        .alias("content_type"),
        body.alias("body"),
    )


def attempt_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempt log as a stream, a second between attempts in `logged_at`; the last micro-batch is a sign of life of a
    day later, after which every request has ended."""
    rows = attempts(spark, sf_dir).withColumn("logged_at", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("seq")))
    newest, count = table(spark, sf_dir, "events").agg(F.max("event_id"), F.count(F.lit(1))).first()
    newest = newest or 0
    thirds = ((0, newest // 3), (newest // 3 + 1, 2 * newest // 3), (2 * newest // 3 + 1, newest))
    alive = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[:-1]]
    end = spark.range(1).select(*alive, F.timestamp_seconds(F.lit(1_704_067_200 + 86_400 + newest)).alias("logged_at"))
    return _followed([*[rows.where(F.col("seq").between(*third)) for third in thirds], end], count, "attempts")


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses (even `seq`) and requests (odd `seq`); a fifth of all rows share one path."""
    k = F.col("k") % 5
    base = F.concat(F.lit("/entity/"), F.col("id"))
    path = (
        F.when(k == 0, F.lit("/destinations"))
        .when(k == 1, base)
        .when(k == 2, F.concat(base, F.lit("/children")))
        .when(k == 3, F.concat(base, F.lit("/schedule/2024/01")))
        .otherwise(F.concat(base, F.lit("/live")))
    )
    return polls(spark, sf_dir).select(
        "seq",
        F.col("ts").cast("timestamp").alias("at"),
        (F.col("seq") % 2 == 0).alias("stored"),
        path.alias("path"),
        F.struct("id", "status").alias("poll"),
    )


def stored_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic(spark, sf_dir).where("stored").select(
        "seq",
        "path",
        F.col("at").alias("fetched_at"),
        F.lit(200).alias("status"),
        F.lit("application/json").alias("content_type"),
        F.lit("{}").alias("body"),
    )


def landed_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a stored response, with a body of its own."""
    body = F.to_json(F.struct(F.col("seq").alias("poll"), F.col("poll.id"), F.col("poll.status")))
    return traffic(spark, sf_dir).select(
        "seq",
        "path",
        F.col("at").alias("fetched_at"),
        F.lit(200).alias("status"),
        F.lit("application/json").alias("content_type"),
        body.alias("body"),
    )


def requested_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic(spark, sf_dir).where(~F.col("stored")).select("seq", "path", F.col("at").alias("requested_at"))
