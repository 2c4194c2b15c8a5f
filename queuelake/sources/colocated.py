"""Tables stored in buckets by the keys they are joined on, so that neither joins nor aggregates move their rows.

A bucket is a file that holds all rows of some keys, sorted. Keys are chosen so that no key is long: responses lie by
path and day, schedule entries by entity and month page, however busy the path or the entity. The tables are those of
the session's catalog; `open_table` names a stored one again in another session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESPONSE_KEYS = ("path", "day")
ENTRY_KEYS = ("entity_id", "year", "month")


def store_table(rows: DataFrame, name: str, location: str, keys: tuple[str, ...], order: tuple[str, ...], buckets: int) -> DataFrame:
    """Store rows in one sorted file per bucket, as the table `name`."""
    dealt = rows.repartition(buckets, *keys)
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", location).mode("overwrite").saveAsTable(name)
    return rows.sparkSession.table(name)


def open_table(spark: SparkSession, name: str, location: str, schema: T.StructType, keys: tuple[str, ...], order: tuple[str, ...], buckets: int) -> DataFrame:
    """The table stored at a location by `store_table`, with the same keys, order and buckets."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by, along = (", ".join(f"`{c}`" for c in names) for names in (keys, (*keys, *order)))
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({along}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return spark.table(name)


def store_responses(bronze: DataFrame, name: str, location: str, buckets: int) -> DataFrame:
    """Landed responses by path and the day they were fetched."""
    dated = bronze.withColumn("day", F.to_date("fetched_at"))
    return store_table(dated, name, location, RESPONSE_KEYS, ("fetched_at", "seq"), buckets)


def store_entries(entries: DataFrame, name: str, location: str, buckets: int) -> DataFrame:
    """Schedule entries by entity and page, as `schedule.ranges` joins them."""
    return store_table(entries, name, location, ENTRY_KEYS, ("date", "seq", "ord"), buckets)


def newest_per_path(responses: DataFrame) -> DataFrame:
    """Newest stored response of every path, of a table made by `store_responses`.

    The newest of each day is found inside the buckets. Only path, moment and number of those are shuffled, to find the
    newest day and to go back to its bucket for the body; the table itself is read where it lies.
    """
    good = responses.where(F.col("status").between(200, 299))
    daily = good.groupBy("path", "day").agg(F.max(F.struct("fetched_at", "seq")).alias("newest"))
    newest = daily.groupBy("path").agg(F.max(F.struct("newest", "day")).alias("n")).select("path", "n.day", "n.newest")
    # Not an equality of columns, which would become keys of the join and ask for another distribution.
    met = newest.join(good, ["path", "day"]).where(F.struct("fetched_at", "seq") >= F.col("newest"))
    return met.drop("newest", "day")
