"""Exact deduplication over an extendible-hash index kept in shared files.

The index is written in two steps. `index_entries` stores one small row per slice of rows with equal text: the key
(a hash of the normalised text), sizes, members. `directory` starts with one bucket and doubles while a bucket holds
more than `bucket_bytes`; a bucket that holds a single key cannot be split further and gets overflow pages instead.
A bucket is a range of keys. Its owner task reads the texts of the range, chains texts whose keys collide and
compares bytes with every text of the chain. Chains of paged keys are compared once more among the pages' heads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm import textbytes
from queuelake.llm.shared import stored
from queuelake.session import prepare

_STEP = 10
_MEMBERS = pa.list_(pa.struct([("doc_id", pa.int64()), ("n_points", pa.int64())]))
_ENTRY = pa.schema([("rid", pa.int64()), ("key", pa.int64()), ("sha", pa.string()), ("n_bytes", pa.int64()), ("members", _MEMBERS), ("body", pa.binary())])
_ENTRY_SQL = "rid bigint, key bigint, sha string, n_bytes bigint, members array<struct<doc_id:bigint,n_points:bigint>>, body binary"


def digest_key(body: bytes) -> int:
    """Signed 64-bit key of a normalised text."""
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "big", signed=True)


def _entries(key: Callable[[bytes], int], with_body: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        rid = context.partitionId() << 33 if context else 0
        for rows, data, offsets in textbytes.slices(batches, 2 << 20):
            kept = ~textbytes.spaces(data)
            count = np.zeros(len(data) + 1, np.int64)
            np.cumsum(kept, out=count[1:])
            ends = count[offsets]
            solid = data[kept].tobytes()
            points = textbytes.code_points(data, offsets)
            seen: dict[bytes, list] = {}
            for i, doc in enumerate(rows.column("doc_id").to_pylist()):
                seen.setdefault(solid[ends[i] : ends[i + 1]], []).append({"doc_id": doc, "n_points": int(points[i])})
            bodies = list(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(rid, rid + len(bodies)), pa.int64()),
                    pa.array([key(b) for b in bodies], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string()),
                    pa.array([len(b) for b in bodies], pa.int64()),
                    pa.array(list(seen.values()), _MEMBERS),
                    pa.array(bodies if with_body else [None] * len(bodies), pa.binary()),
                ],
                schema=_ENTRY,
            )
            rid += len(bodies)

    return run


def index_entries(docs: DataFrame, key: Callable[[bytes], int] = digest_key, with_body: bool = False) -> DataFrame:
    """One row per slice of rows and distinct normalised text: rid, key, sha, n_bytes, members, body.

    Equal texts of a slice are one row already, so a text that a third of all rows share travels once per slice.
    """
    return docs.select("doc_id", "text").mapInArrow(_entries(key, with_body), _ENTRY_SQL)


def directory(index: DataFrame, bucket_bytes: int) -> list[tuple[int, int, int]]:
    """(first key, depth, pages) of each bucket in key order, from the sizes in the stored index.

    The depth is the number of leading key bits that the bucket's keys share. Cells are counted in Spark, `_STEP`
    bits deeper each round and only inside buckets that are too large; the rows that reach the driver are bounded by
    the bytes of all texts divided by `bucket_bytes`, times 2^_STEP.
    """
    unsigned = lambda k: k & ((1 << 64) - 1)
    done: list[tuple[int, int, int]] = []
    depth, large = 0, [0]
    while large and depth < 64:
        step = min(_STEP, 64 - depth)
        rows = index
        if depth:
            parents = index.sparkSession.createDataFrame([(p - (1 << depth) if p >> (depth - 1) else p,) for p in large], "parent bigint")
            rows = index.join(parents, F.shiftright("key", 64 - depth) == F.col("parent"), "left_semi")
        cells = rows.groupBy(F.shiftright("key", 64 - depth - step).alias("cell")).agg(
            F.sum("n_bytes").alias("size"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        sizes = {unsigned(r.cell) & ((1 << (depth + step)) - 1): (r.size, r.low == r.high) for r in cells.collect()}
        deeper: list[int] = []

        def split(prefix: int, bits: int, depth: int = depth, step: int = step, sizes: dict = sizes, deeper: list = deeper) -> None:
            under = depth + step - bits
            inside = [(c, *sizes[c]) for c in range(prefix << under, (prefix + 1) << under) if c in sizes] if under else [(prefix, *sizes.get(prefix, (0, True)))]
            total = sum(x[1] for x in inside)
            if total <= bucket_bytes or (len(inside) == 1 and inside[0][2]) or bits == 64:
                done.append((prefix << (64 - bits), bits, max(1, -(-total // bucket_bytes))))
            elif under:
                split(prefix << 1, bits + 1)
                split(prefix << 1 | 1, bits + 1)
            else:
                deeper.append(prefix)

        for prefix in large:
            split(prefix, depth)
        depth, large = depth + step, deeper
    return sorted(done)


def _owner(table: pa.Table) -> pa.Table:
    """Chains of one bucket page: for each entry the rid of the equal text that came first."""
    chains: dict[int, list[tuple[bytes, int]]] = {}
    heads = []
    order = np.argsort(table.column("rid").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    for rid, key, body in zip(table.column("rid").to_pylist(), table.column("key").to_pylist(), table.column("body"), strict=True):
        body = body.as_py() or b""
        chain = chains.setdefault(key, [])
        head = next((r for b, r in chain if b == body), None)
        if head is None:
            chain.append((body, rid))
        heads.append(rid if head is None else head)
    first = pa.array(np.array(heads) == table.column("rid").to_numpy()) if heads else pa.array([], pa.bool_())
    bodies = pc.if_else(pc.and_(first, pc.greater(table.column("pages"), 1)), table.column("body"), pa.scalar(None, pa.binary()))
    return table.set_column(table.schema.get_field_index("body"), "body", bodies).append_column("head", pa.array(heads, pa.int64())).select(
        ["rid", "key", "sha", "members", "body", "head"]
    )


def exact_groups(docs: DataFrame, bucket_bytes: int = 16 << 20, key: Callable[[bytes], int] = digest_key) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without the characters of `[\\x20\\x09-\\x0D]`; null counts as empty. The row with
    the most code points in the original text stays, then the smallest doc_id (null ids last). Rows that repeat a
    doc_id count as rows of their own; if such an id is the keep_id, all rows of that id and class are kept. Columns other than
    doc_id and text are not read. An empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    index = stored(index_entries(docs, key).drop("body"), "hash-index")
    buckets = directory(index, bucket_bytes)
    # One row per bucket: bounded by the bytes of the texts over half of bucket_bytes.
    lows = np.array([b[0] for b in buckets], np.uint64)
    pages = np.array([b[2] for b in buckets], np.int64)
    place = spark.sparkContext.broadcast((lows, pages))

    def address(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, pages = place.value
        for batch in _entries(key, True)(batches):
            bucket = np.searchsorted(lows, batch.column("key").to_numpy().view(np.uint64), "right") - 1
            page = batch.column("rid").to_numpy() % pages[bucket] if len(batch) else np.empty(0, np.int64)
            extra = [pa.array(bucket, pa.int64()), pa.array(page, pa.int64()), pa.array(pages[bucket] if len(batch) else page, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "bucket", "page", "pages"])

    filed = docs.select("doc_id", "text").mapInArrow(address, f"{_ENTRY_SQL}, bucket bigint, page bigint, pages bigint")
    owned = filed.groupBy("bucket", "page").applyInArrow(
        _owner, "rid bigint, key bigint, sha string, members array<struct<doc_id:bigint,n_points:bigint>>, body binary, head bigint"
    )
    owned = stored(owned, "hash-chains")
    # Heads of the pages of one key: as many as pages, each with one text per chain link.
    heads = owned.where("body IS NOT NULL").select("rid", "key", "sha", "members", "body", F.lit(1).alias("pages"))
    joined = heads.groupBy("key").applyInArrow(
        _owner, "rid bigint, key bigint, sha string, members array<struct<doc_id:bigint,n_points:bigint>>, body binary, head bigint"
    )
    joined = joined.select(F.col("rid").alias("head"), F.col("head").alias("first"))
    classed = owned.drop("body", "key").join(joined, "head", "left").withColumn("class", F.coalesce("first", "head"))
    order = F.expr("array_max(transform(members, m -> struct(m.n_points, coalesce(-m.doc_id, -9223372036854775808L) AS back, m.doc_id)))")
    totals = classed.groupBy("class").agg(F.max(order).alias("best"), F.sum(F.size("members")).alias("group_size"))
    rows = classed.join(totals, "class").select(
        F.explode("members").alias("m"), F.col("best.doc_id").alias("keep_id"), "group_size", F.col("sha").alias("text_sha256")
    )
    return rows.select(F.col("m.doc_id").alias("doc_id"), "keep_id", "group_size", F.col("m.doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
