"""Which deliveries of a stored lake count: readers go by published manifests, never by what lies in the folders.

An attempt at a delivery writes below folders of its own. Publishing it is one small file that names the delivery, the
attempt and what it holds; it appears whole or not at all. The newest manifest of a delivery wins, so a delivery that is
run again shows as it was until the repetition is whole. Only then the attempts before it are deleted.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelake.session import delete, file_system

_SCHEMA = (
    "delivery string, attempt string, published_at timestamp, replaces array<string>, responses bigint,"
    " accepted map<string,bigint>, rejected map<string,bigint>, rules map<string,bigint>, tables map<string,bigint>"
)


def exists(spark: SparkSession, location: str) -> bool:
    files, path = file_system(spark, location)
    return files.exists(path)


def folders(spark: SparkSession, location: str) -> list[str]:
    """Names of the folders directly below a location; none if it is not there."""
    files, path = file_system(spark, location)
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()) if files.exists(path) else []


def new_attempt() -> str:
    return uuid4().hex


def publish(
    spark: SparkSession,
    location: str,
    delivery: str,
    attempt: str,
    responses: int,
    accepted: dict[str, int],
    rejected: dict[str, int],
    rules: dict[str, int],
    tables: dict[str, int],
    replaces: tuple[str, ...] = (),
) -> None:
    """Make an attempt the one that counts, in the place of the deliveries it replaces; then drop what no longer does."""
    row = [(delivery, attempt, None, list(replaces), responses, accepted, rejected, rules, tables)]
    manifest = spark.createDataFrame(row, _SCHEMA).withColumn("published_at", F.current_timestamp())
    manifest.coalesce(1).write.json(f"{location}/deliveries/version={attempt}")
    for gone in {delivery, *replaces}:
        for name in tables_below(spark, location):
            for old in folders(spark, f"{location}/{name}/delivery={gone}"):
                if old != f"attempt={attempt}":
                    delete(spark, f"{location}/{name}/delivery={gone}/{old}")


def tables_below(spark: SparkSession, location: str) -> list[str]:
    """Names of all tables that any attempt has written, as `live` or `rejects/live`."""
    found = []
    for name in folders(spark, location):
        if name == "deliveries":
            continue
        inside = folders(spark, f"{location}/{name}")
        found += [f"{name}/{kind}" for kind in inside if "=" not in kind]
        found += [name] if any(kind.startswith("delivery=") for kind in inside) else []
    return found


def manifests(spark: SparkSession, location: str) -> DataFrame:
    """The manifest of every delivery that counts."""
    if not exists(spark, f"{location}/deliveries"):
        return spark.createDataFrame([], _SCHEMA)
    every = spark.read.schema(_SCHEMA).json(f"{location}/deliveries")
    newest = every.groupBy("delivery").agg(F.max_by(F.struct(*[c for c in every.columns if c not in ("delivery", "version")]), F.struct("published_at", "attempt")).alias("m"))
    current = newest.select("delivery", "m.*")
    gone = every.select(F.explode("replaces").alias("delivery"), F.col("published_at").alias("gone_at")).groupBy("delivery").agg(F.max("gone_at").alias("gone_at"))
    return current.join(gone, "delivery", "left").where("gone_at IS NULL OR gone_at < published_at").drop("gone_at")


def attempt_folders(spark: SparkSession, location: str, name: str) -> list[str]:
    """Folders that hold the rows of a table that count: one per delivery with rows of it."""
    rows = manifests(spark, location).where(F.map_contains_key("tables", F.lit(name))).select("delivery", "attempt").collect()
    return [f"{location}/{name}/delivery={r.delivery}/attempt={r.attempt}" for r in rows]


def counts(spark: SparkSession, location: str) -> DataFrame:
    """Per delivery and kind: how many responses were accepted and rejected; `unrouted` are of no kind."""
    rows = manifests(spark, location)
    kinds = rows.select("delivery", F.explode(F.array_union(F.map_keys("accepted"), F.map_keys("rejected"))).alias("kind"), "accepted", "rejected")
    found = lambda c: F.coalesce(F.col(c)[F.col("kind")], F.lit(0)).alias(c)
    return kinds.select("delivery", "kind", found("accepted"), found("rejected"))


def rule_counts(spark: SparkSession, location: str) -> DataFrame:
    """Per delivery, kind, rule and field: how many rejects, as counted while they were written."""
    rows = manifests(spark, location).select("delivery", F.explode("rules").alias("key", "rejects"))
    return rows.select("delivery", *[F.get_json_object("key", f"$[{i}]").alias(c) for i, c in enumerate(("kind", "rule", "field"))], "rejects")


def rule_key(kind: str, rule: str, field: str) -> str:
    return json.dumps([kind, rule, field])
