"""Writing typed tables and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from queuelake.sources.bronze import route
from queuelake.sources.validate import check

# A column of few values keeps its dictionary; one of many (bodies, ids, prices, instants) gives it up after 32 KB, not
# after a megabyte in which every further value is looked up. Row groups are small, since tasks share a file by them.
_PARQUET = {"compression": "zstd", "parquet.dictionary.page.size": "32768", "parquet.block.size": "8388608"}


def write_bronze(responses: DataFrame, location: str, mode: str = "append") -> None:
    """Store responses partitioned so that a scan of one kind or month page reads only its folders.

    Rows of a file are in order of their path, so a scan for one entity skips the row groups of the others."""
    write_table(route(responses).drop("entity_id"), location, ("endpoint", "year", "month"), mode, order=("path",))


def write_checked(bronze: DataFrame, kind: str, location: str, mode: str = "append") -> DataFrame:
    """Decode and check once; valid and broken documents land side by side under `valid=`.

    Returns what is stored there, so that later steps start from the table and not from the bodies.
    """
    checked = check(bronze, kind)
    checked.write.mode(mode).partitionBy("valid").parquet(location)
    return read_checked(bronze.sparkSession, location, checked.schema)


def read_checked(spark: SparkSession, location: str, schema: StructType | None = None) -> DataFrame:
    """Documents stored by `write_checked`; a filter on `valid` reads one of the two folders."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(location).withColumn("valid", F.col("valid").cast("boolean"))


def write_table(
    rows: DataFrame,
    location: str,
    partition_by: tuple[str, ...] = (),
    mode: str = "append",
    observe: tuple[Observation, dict[str, Column]] | None = None,
    order: tuple[str, ...] = (),
    gather: bool = True,
) -> None:
    """Store a typed table. Rows of one folder are spread over several tasks, so a hot folder is no
    single writer; AQE merges the small ones. Without `gather` every task writes a file of its own in each folder it
    has rows of: no row is shuffled for it. What is to be observed is counted on the way into the files."""
    if partition_by and gather:
        rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    if order:
        rows = rows.sortWithinPartitions(*partition_by, *order)
    if observe is not None:
        # Last of all: below a shuffle that turns out empty a count would be optimized away.
        rows = rows.observe(observe[0], *[c.alias(n) for n, c in observe[1].items()])
    rows.write.mode(mode).options(**_PARQUET).partitionBy(*partition_by).parquet(location)
