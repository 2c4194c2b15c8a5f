"""From landed responses to stored typed tables, parsing every body once."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from queuelake.operators import flatten
from queuelake.operators.live import queue_offers
from queuelake.schemas import BRONZE
from queuelake.session import delete, scratch_path, scratch_scope
from queuelake.sources import deliveries, sinks, validate
from queuelake.sources.bronze import route

Flat = Callable[[DataFrame], DataFrame]
#: Tables of one kind that are written at a time.
WRITERS = 4


def _dated(flat: Flat) -> Flat:
    """Rows with the day of the poll, by which live tables are stored."""
    return lambda rows: flat(rows).withColumn("poll_date", F.to_date("fetched_at"))


# Per kind: the typed tables made from its documents (or from a table named before), and the folders each is stored by.
TABLES: dict[str, dict[str, tuple[str, Flat, tuple[str, ...]]]] = {
    "destinations": {
        "destinations": ("documents", flatten.destinations, ()),
        "destination_parks": ("destinations", flatten.destination_parks, ()),
    },
    "entity": {
        "entities": ("documents", flatten.entities, ("entity_type",)),
        "tags": ("entities", flatten.tags, ()),
    },
    "children": {"descendants": ("documents", flatten.descendants, ("entity_type",))},
    "live": {
        "live": ("documents", _dated(flatten.live), ("poll_date",)),
        "offers": ("live", queue_offers, ("poll_date",)),
        "showtimes": ("live", _dated(flatten.showtimes), ("poll_date",)),
        "operating_hours": ("live", _dated(flatten.operating_hours), ("poll_date",)),
        "dining": ("live", _dated(flatten.dining), ("poll_date",)),
    },
    "schedule": {
        "schedule": ("documents", flatten.schedule, ("year", "month")),
        "purchases": ("schedule", flatten.purchases, ()),
        "destination_schedule": ("owners", flatten.nested_schedule, ()),
    },
}


def _kind() -> Column:
    taken = F.col("endpoint").isin(*TABLES) & F.col("status").between(200, 299)
    return F.when(F.coalesce(taken, F.lit(False)), F.col("endpoint")).otherwise("unrouted")


def unrouted(responses: DataFrame) -> DataFrame:
    """Responses that no kind takes, in the form of rejects: rule ROUTE, and what is amiss as the field."""
    rest = route(responses).where(_kind() == "unrouted")
    amiss = F.when(F.col("endpoint").isin(*TABLES), "status").otherwise("path")
    return rest.select("seq", "path", "fetched_at", "body", F.lit("ROUTE").alias("rule"), amiss.alias("field"))


class _Attempt:
    """Folders and counts of one attempt at a delivery. Counts are observed while rows are written, without a scan of their own."""

    def __init__(self, spark: SparkSession, location: str, delivery: str) -> None:
        self.spark, self.location, self.delivery, self.name = spark, location, delivery, deliveries.new_attempt()
        self.accepted: dict[str, int] = {}
        self.rejected: dict[str, int] = {}
        self.rules: dict[str, int] = {}
        self.tables: dict[str, int] = {}

    def write(self, rows: DataFrame, name: str, folders: tuple[str, ...] = (), gather: bool = False, mode: str = "overwrite", **counts: Column) -> dict[str, int]:
        seen = Observation()
        sinks.write_table(rows, self.folder(name), folders, mode, (seen, {"rows": F.count(F.lit(1)), **counts}), gather=gather)
        if seen.get["rows"] and mode == "overwrite":
            self.tables[name] = seen.get["rows"]
        return seen.get

    def write_schedules(self, responses: DataFrame) -> tuple[validate.ScheduleLevels, dict[str, int]]:
        """Documents whose own level tells whether they are valid go where they belong as they are parsed. Those with
        parks lie beside them, below no value of `valid`, until the levels below are read (see `drop_open`)."""
        name, seen = "documents/schedule", {}
        counts = {"accepted": F.count_if("valid"), "rejected": F.count_if(~F.col("valid"))}

        def keep(rows: DataFrame) -> DataFrame:
            seen.update(self.write(rows, name, ("valid",), **counts))
            return self.read(name, rows.schema)

        levels = validate.schedule_levels(responses, keep)
        if seen["rows"] > seen["accepted"] + seen["rejected"]:
            late = self.write(levels.late, name, ("valid",), mode="append", **counts)
            seen.update({c: seen[c] + late[c] for c in counts})
        return levels, seen

    def drop_open(self) -> None:
        """What `write_schedules` has laid beside the valid and the broken documents and has written there by now."""
        delete(self.spark, f"{self.folder('documents/schedule')}/valid=__HIVE_DEFAULT_PARTITION__")

    def folder(self, name: str) -> str:
        return f"{self.location}/{name}/delivery={self.delivery}/attempt={self.name}"

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.folder(name))

    def write_rejects(self, kind: str, found: DataFrame) -> None:
        """Rejects and how many there are of each rule and field, of those that are known to occur."""
        names = [(c.rule, c.field) for c in validate.CHECKS.get(kind, [])] + [("VAL1", "body"), ("VAL1", "content_type"), ("ROUTE", "status"), ("ROUTE", "path")]
        by_rule = {f"r{i}": F.count_if((F.col("rule") == rule) & (F.col("field") == field)) for i, (rule, field) in enumerate(names)}
        # Deeper schedules have fields of their own, which no list holds beforehand.
        seen = self.write(found, f"rejects/{kind}", **by_rule)
        counted = {names[int(key[1:])]: n for key, n in seen.items() if key != "rows" and n}
        if sum(counted.values()) < seen["rows"]:
            rows = self.spark.read.schema(found.schema).parquet(self.folder(f"rejects/{kind}"))
            counted = {(r.rule, r.field): r["count"] for r in rows.groupBy("rule", "field").count().collect()}
        self.rules |= {deliveries.rule_key(kind, *at): n for at, n in counted.items()}

    def publish(self, responses: int, replaces: tuple[str, ...] = ()) -> None:
        deliveries.publish(self.spark, self.location, self.delivery, self.name, responses, self.accepted, self.rejected, self.rules, self.tables, replaces)


def store(responses: DataFrame, location: str, delivery: str) -> None:
    """Write checked documents, typed tables and rejects of one delivery of responses below `location`, and publish it.

    Every response ends up in the documents or the rejects of its kind, or in `rejects/unrouted`: those that failed,
    and those whose path is of no kind. The responses are read once, into a folder per kind; bodies are parsed once, from
    there into `documents/<kind>`; all else is made from tables. Nothing of it shows to `read` before the manifest is
    published. Running a delivery again, after a failure or with other rows, replaces it as a whole.
    """
    spark = responses.sparkSession
    attempt, landed, seen = _Attempt(spark, location, delivery), scratch_path(spark, "landed"), Observation()
    per_kind = {kind: F.count_if(F.col("kind") == kind) for kind in (*TABLES, "unrouted")}
    routed = route(responses).withColumn("kind", _kind())
    schema = T.StructType([f for f in routed.schema.fields if f.name != "kind"])
    try:
        sinks.write_table(routed, landed, ("kind",), observe=(seen, {"rows": F.count(F.lit(1)), **per_kind}), gather=False)
        for kind in (*TABLES, "unrouted"):
            if seen.get[kind]:
                with scratch_scope(spark):
                    _store_kind(attempt, kind, spark.read.schema(schema).parquet(f"{landed}/kind={kind}"))
    finally:
        delete(spark, landed)
    attempt.publish(seen.get["rows"])


def _store_kind(attempt: _Attempt, kind: str, responses: DataFrame) -> None:
    if kind == "unrouted":
        attempt.write_rejects(kind, unrouted(responses))
        attempt.rejected[kind] = attempt.tables[f"rejects/{kind}"]
        return
    sources: dict[str, DataFrame] = {}
    if kind == "schedule":
        # Schedules may repeat below their parks to any depth, which the typed landing form does not hold.
        levels, seen = attempt.write_schedules(responses)
        checked, sources["owners"], rejects = levels.documents.drop("doc_key"), levels.owners, levels.rejects
    else:
        checked, rejects = validate.check(responses, kind), None
        seen = attempt.write(checked, f"documents/{kind}", ("valid",), accepted=F.count_if("valid"), rejected=F.count_if(~F.col("valid")))
    attempt.accepted[kind], attempt.rejected[kind] = seen["accepted"], seen["rejected"]
    checked = attempt.read(f"documents/{kind}", checked.schema)

    def write(name: str) -> None:
        source, flat, folders = TABLES[kind][name]
        rows = flat(sources[source])
        attempt.write(rows, name, folders)
        sources[name] = attempt.read(name, rows.schema)

    # Tables that do not wait for each other are written side by side.
    with ThreadPoolExecutor(WRITERS) as pool:
        jobs = []
        if seen["rejected"]:
            jobs.append(pool.submit(attempt.write_rejects, kind, validate.rejected(checked, kind) if rejects is None else rejects))
        left = list(TABLES[kind]) if seen["accepted"] else []
        sources["documents"] = validate.accepted(checked)
        while left:
            ready = [name for name in left if TABLES[kind][name][0] in sources]
            left = [name for name in left if name not in ready]
            for done in [pool.submit(write, name) for name in ready]:
                done.result()
        for job in jobs:
            job.result()
    if kind == "schedule":
        attempt.drop_open()


def follow(responses: DataFrame, location: str, checkpoint: str, name: str, trigger: str | None = None) -> StreamingQuery:
    """Keep the tables below `location` up to a stream of landed responses, a delivery per micro-batch.

    A delivery is named after the stream and the batch. A batch that is repeated after a failure replaces what it left
    behind, published or not, so every response is in the tables exactly once. `compact` merges small deliveries.
    """

    def deliver(batch: DataFrame, number: int) -> None:
        store(batch, location, f"{name}-{number}")

    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    return responses.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint).trigger(**when).start()


def compact(spark: SparkSession, location: str, into: str, *merged: str) -> None:
    """Merge published deliveries into one, in larger files; readers see the old ones or the new one, never both.

    Deliveries that a stream may still repeat, its newest, are not to be merged.
    """
    attempt = _Attempt(spark, location, into)
    rows = [r for r in deliveries.manifests(spark, location).collect() if r.delivery in merged]
    if {r.delivery for r in rows} != set(merged):
        raise ValueError(f"not published: {sorted(set(merged) - {r.delivery for r in rows})}")
    for name in sorted({t for r in rows for t in r.tables}):
        table = read(spark, location, name, only=merged).drop("delivery")
        folders = ("valid",) if name.startswith("documents/") else next((t[name][2] for t in TABLES.values() if name in t), ())
        attempt.write(table, name, folders, gather=True)
    for r in rows:
        for total, part in ((attempt.accepted, r.accepted), (attempt.rejected, r.rejected), (attempt.rules, r.rules)):
            for key, n in part.items():
                total[key] = total.get(key, 0) + n
    attempt.publish(sum(r.responses for r in rows), tuple(merged))


def schema_of(spark: SparkSession, name: str) -> T.StructType:
    """Columns of a stored table, as the code makes them."""
    nothing = spark.createDataFrame([], BRONZE)
    group, _, kind = name.partition("/")
    if group == "rejects":
        return unrouted(nothing).schema
    if group == "documents":
        return validate.check(nothing, kind).schema if kind != "schedule" else _schedule_documents(nothing)
    kind = next(k for k, tables in TABLES.items() if name in tables)
    source, flat, _ = TABLES[kind][name]
    if source == "owners":
        return flat(spark.createDataFrame([], _OWNERS)).schema
    base = schema_of(spark, f"documents/{kind}" if source == "documents" else source)
    return flat(spark.createDataFrame([], base)).schema


_OWNERS = T.StructType(
    [
        *[f for f in BRONZE.fields if f.name in ("seq", "path", "fetched_at")],
        T.StructField("root_id", T.StringType()),
        T.StructField("owner_place", T.ArrayType(T.IntegerType())),
        T.StructField("record", validate.S.SCHEDULE_LEVEL),
    ]
)


def _schedule_documents(nothing: DataFrame) -> T.StructType:
    typed = validate.check(nothing, "schedule").schema
    return T.StructType([T.StructField("doc", validate.S.SCHEDULE_LEVEL) if f.name == "doc" else f for f in typed.fields])


def read(spark: SparkSession, location: str, name: str, only: tuple[str, ...] | None = None) -> DataFrame:
    """A stored table, by its name or as `documents/<kind>`, `rejects/<kind>` or `rejects/unrouted`: all published
    deliveries, or `only` some of them.

    The schema is that of the code, not of the files: a kind that no delivery had a row of reads as empty, and
    `delivery` is text whatever its values look like.
    """
    schema = T.StructType([*schema_of(spark, name).fields, T.StructField("delivery", T.StringType())])
    found = deliveries.attempt_folders(spark, location, name)
    if only is not None:
        found = [f for f in found if f.split("/delivery=")[-1].split("/")[0] in only]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{location}/{name}").parquet(*found).drop("attempt")
