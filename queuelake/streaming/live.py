"""Following the live feed with the batch expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from queuelake.operators import flatten
from queuelake.operators.live import current_state, queue_offers
from queuelake.schemas import BRONZE
from queuelake.session import delete, scratch_scope, stored
from queuelake.sources.deliveries import exists, folders
from queuelake.sources.sinks import write_table
from queuelake.sources.validate import documents


#: Files of one micro-batch unless an option says otherwise: a backlog becomes many batches, and watermarks move on.
FILES_PER_TRIGGER = 1000
#: Keyed state outgrows a heap; this store keeps it on the executors' disks and in checkpoints.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_responses(spark: SparkSession, location: str, **options: str) -> DataFrame:
    """Landed responses as a stream of line-delimited JSON files."""
    rate = {} if {"maxFilesPerTrigger", "maxBytesPerTrigger"} & set(options) else {"maxFilesPerTrigger": str(FILES_PER_TRIGGER)}
    return spark.readStream.schema(BRONZE).options(**rate, **options).json(location)


def live_rows(responses: DataFrame) -> DataFrame:
    """Typed live rows of a stream of responses; stateless."""
    return flatten.live(documents(responses, "live"))


def offers(responses: DataFrame) -> DataFrame:
    """Queue offers of a stream of responses; stateless."""
    return queue_offers(live_rows(responses))


def first_sightings(rows: DataFrame, delay: str) -> DataFrame:
    """Drop repeated polls of one entity state. State is kept for `delay` beyond the newest update; rows later
    than that are dropped, and counted in the query's progress as `numRowsDroppedByWatermark`."""
    watermarked = rows.withWatermark("last_updated", delay)
    return watermarked.dropDuplicatesWithinWatermark(["id", "last_updated"])


def _started(rows: DataFrame, mode: str, checkpoint: str, trigger: str | None) -> DataStreamWriter:
    """`trigger` is an interval to keep running by; without one, what is there now is worked off."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    return rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**when)


#: Buckets of a board, by entity. A trigger writes again only the buckets that hold a changed entity.
BOARD_BUCKETS = 64


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def write_board(
    rows: DataFrame, location: str, checkpoint: str, *columns: str, trigger: str | None = None, buckets: int = BOARD_BUCKETS
) -> StreamingQuery:
    """Keep the current board (newest row per entity); a trigger writes what its rows changed, not the board.

    The board is stored by buckets of entities. A micro-batch shrinks to its newest row per entity, is merged with the
    buckets it touches, and only those are written again, under the number of the batch. A small table, published
    last, names the batch that holds each bucket: a board shows whole or as it was, and a batch that is repeated after
    a failure merges into what the batch before it left, so it counts once. No streaming state is kept: the board is the
    state. Folders that no published bucket lies in are deleted.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = current_state(batch, *columns).withColumn("bucket", _bucket(buckets))
        newest = stored(newest, "board-changes")
        touched = {r.bucket for r in newest.select("bucket").distinct().collect()}
        # What a failed run of this very batch may have published is not what it started from.
        before = _placed(spark, location, upto=number - 1)
        held = {bucket: of for bucket, of in before.items() if bucket in touched}
        if touched:
            merged = newest
            if held:
                old = _buckets(spark, location, held, newest.schema)
                merged = current_state(old.unionByName(newest), *[c for c in newest.columns if c not in ("id", "last_updated", "seq", "ord")])
            write_table(merged, f"{location}/buckets/batch={number}", ("bucket",), "overwrite")
        placed = before | dict.fromkeys(touched, number)
        manifest = spark.createDataFrame([(number, json.dumps(placed))], "batch bigint, placed string")
        manifest.coalesce(1).write.mode("overwrite").json(f"{location}/published/version={number}")
        # The version before stays readable, for readers that go by it and for a repetition of this batch.
        used = set(placed.values()) | set(before.values())
        for folder in folders(spark, f"{location}/buckets"):
            if int(folder.removeprefix("batch=")) not in used:
                delete(spark, f"{location}/buckets/{folder}")
        for folder in folders(spark, f"{location}/published"):
            if int(folder.removeprefix("version=")) < number - 1:
                delete(spark, f"{location}/published/{folder}")

    def scoped(batch: DataFrame, number: int) -> None:
        with scratch_scope(batch.sparkSession):
            store(batch, number)

    return _started(rows, "append", checkpoint, trigger).foreachBatch(scoped).start()


def published(spark: SparkSession, location: str, upto: int | None = None) -> int | None:
    """Number of the newest whole version, if there is one, or of the newest up to a batch."""
    found = [int(f.removeprefix("version=")) for f in folders(spark, f"{location}/published")]
    found = [n for n in found if (upto is None or n <= upto) and exists(spark, f"{location}/published/version={n}/_SUCCESS")]
    return max(found, default=None)


def _placed(spark: SparkSession, location: str, upto: int | None = None) -> dict[int, int]:
    """For every bucket that has rows, the batch whose folder holds it; at most one entry per bucket."""
    version = published(spark, location, upto)
    if version is None:
        return {}
    row = spark.read.schema("batch bigint, placed string").json(f"{location}/published/version={version}").first()
    return {int(bucket): batch for bucket, batch in json.loads(row.placed).items()}


def _buckets(spark: SparkSession, location: str, placed: dict[int, int], schema: StructType | None = None) -> DataFrame:
    paths = [f"{location}/buckets/batch={batch}/bucket={bucket}" for bucket, batch in sorted(placed.items())]
    reader = spark.read.option("basePath", f"{location}/buckets")
    return (reader.schema(schema) if schema is not None else reader).parquet(*paths).drop("batch")


def read_board(spark: SparkSession, location: str) -> DataFrame:
    """The newest board that `write_board` has published; buckets being written do not show."""
    return _buckets(spark, location, _placed(spark, location)).drop("bucket")


def append_table(rows: DataFrame, location: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Append a stateless or deduplicated stream to a Parquet table, exactly once."""
    return _started(rows, "append", checkpoint, trigger).format("parquet").start(location)
