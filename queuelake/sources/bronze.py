"""The lake of landed responses: reading it, routing it, decoding it once.

A bronze row is `(seq, path, fetched_at, status, content_type, body)`. `seq` orders responses fetched
at the same instant. When a lake is stored partitioned by `endpoint`, `year` and `month`, a scan of one
kind or one month page prunes to those folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelake.functions import paths
from queuelake.schemas import BRONZE, CORRUPT, LANDING

ROUTE_COLUMNS = ("endpoint", "entity_id", "year", "month")


def read_bronze(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """Landed responses from Parquet or line-delimited JSON, with the fixed schema."""
    partitions = [
        T.StructField("endpoint", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
    schema = T.StructType(BRONZE.fields + partitions) if fmt == "parquet" else BRONZE
    return spark.read.schema(schema).format(fmt).load(location)


def route(bronze: DataFrame) -> DataFrame:
    """Add endpoint, decoded entity id, and year and month of a schedule page."""
    path = F.col("path")
    columns = {
        "endpoint": paths.endpoint(path),
        "entity_id": paths.path_entity_id(path),
        "year": paths.path_year(path),
        "month": paths.path_month(path),
    }
    return bronze.withColumns({k: v for k, v in columns.items() if k not in bronze.columns})


def of_kind(bronze: DataFrame, kind: str) -> DataFrame:
    """Successful responses of one endpoint; prunes folders when the lake is partitioned by endpoint."""
    return route(bronze).where((F.col("endpoint") == kind) & F.col("status").between(200, 299))


def month_page(bronze: DataFrame, year: int, month: int) -> DataFrame:
    """Landed pages of one calendar month; prunes folders when the lake is partitioned."""
    pages = route(bronze)
    return pages.where(
        (F.col("endpoint") == "schedule") & (F.col("year") == year) & (F.col("month") == month)
    )


def upcoming(bronze: DataFrame) -> DataFrame:
    """Landed schedule responses that are not month pages."""
    return route(bronze).where((F.col("endpoint") == "schedule") & F.col("month").isNull())


def decode(bronze: DataFrame, kind: str, landing: T.StructType | None = None) -> DataFrame:
    """Parse each body once into `doc` (all scalars text) and `corrupt`.

    The body is parsed as the only element of a list inside a wrapper object that closes with a marker.
    Text after the document, several documents, an array or a bare scalar break the list or hide the
    marker, so they are errors rather than half-read documents. The parse sits inside a generator: later
    filters and projections read its output and never repeat it.
    """
    wrapper = T.StructType(
        [
            T.StructField("doc", T.ArrayType(landing or LANDING[kind])),
            T.StructField("end", T.StringType()),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "allowSingleQuotes": "false",
    }
    wrapped = F.concat(F.lit('{"doc":['), F.col("body"), F.lit('],"end":"end"}'))
    parsed = bronze.select("*", F.explode(F.array(F.from_json(wrapped, wrapper, options))).alias("_p"))
    whole = (
        F.col(f"_p.{CORRUPT}").isNull()
        & F.col("_p.end").isNotNull()
        & (F.size("_p.doc") == 1)
        & F.get("_p.doc", F.lit(0)).isNotNull()
    )
    broken = ~F.coalesce(whole, F.lit(False))
    return parsed.select("*", F.get("_p.doc", F.lit(0)).alias("doc"), broken.alias("corrupt")).drop("_p")


def newest_per_path(bronze: DataFrame) -> DataFrame:
    """Newest stored response of every path. Only keys travel through the aggregate, bodies do not."""
    stored = bronze.where(F.col("status").between(200, 299))
    newest = stored.groupBy("path").agg(
        F.max(F.struct("fetched_at", "seq")).alias("_newest")
    )
    keys = newest.select("path", "_newest.fetched_at", "_newest.seq")
    return keys.join(stored, ["path", "fetched_at", "seq"])
