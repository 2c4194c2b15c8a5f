"""Intermediate tables in the cluster's shared folder, and connected components over stored links."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelake.session import scratch_path


def _nullable(kind: T.DataType) -> T.DataType:
    text = json.dumps(kind.jsonValue()).replace('"nullable": false', '"nullable": true').replace('"containsNull": false', '"containsNull": true')
    return T.StructType.fromJson(json.loads(text))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write once below spark.checkpoint.dir and read back: lineage ends at files every executor reaches."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(_nullable(frame.schema)).parquet(path)


#: Most ids that are sent to every executor at once (a long each); more are joined by a shuffle.
BROADCAST_IDS = 4_000_000


def with_ids(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose `column` is among distinct stored ids; the ids travel to the rows while they are few enough."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, column, "left_semi")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_hash(column: str = "doc_id") -> F.Column:
    """crc32 of the id as text, the number that decides the folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) for every id in a link (a, b); component_id is the smallest id reachable.

    Alternating stars: each round hangs all larger neighbours, then all smaller ones, below the smallest
    neighbour, until the links no longer change. Minimums combine before the shuffle and the joins may be split,
    so an id with very many links needs no task that holds them all. Rounds are stored in the shared folder.
    """
    pair = lambda a, b: (F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    edges = stored(links.where("a <> b").select(*pair("a", "b")).distinct(), "links")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        hung = large.join(small, "hi").select(F.explode(F.array(F.struct(F.col("hi").alias("x"), "m"), F.struct(F.col("lo").alias("x"), "m"))).alias("e"))
        edges = stored(hung.where("e.x <> e.m").select(F.col("e.x").alias("hi"), F.col("e.m").alias("lo")).distinct(), "links")
    found = edges.groupBy("hi").agg(F.min("lo").alias("component_id")).withColumnRenamed("hi", "id")
    return found.union(edges.select("lo", "lo").distinct()).groupBy("id").agg(F.min("component_id").alias("component_id"))
