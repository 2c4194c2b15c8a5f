"""Which stored response would have answered a request: an as-of join with a freshness limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queuelake.functions.paths import endpoint, ttl_seconds
from queuelake.session import stored as stored_rows

_SECOND = 1_000_000  # microseconds


def fresh_hits(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Each request `(seq, path, requested_at)` with the response that answers it, or nulls.

    The newest response stored no later than the request counts, and only while it is younger than the
    limit of its endpoint. A stored null body is never a hit, but it still replaces what was stored
    before it.

    No task needs all moments of a path, whatever share of the rows it has:
      1. requests and responses are sorted by path and moment over range partitions, so a busy path lies in many;
      2. inside a part, a window finds the last response before each request;
      3. each part hands on the last response of each path in it; of the parts that follow, those without one of their
         own before a request take it from there. There is a row per path and part of these.
    """
    limited = F.coalesce(ttl_seconds(endpoint(F.col("path"))) > 0, F.lit(False))
    response = F.struct(F.col("fetched_at").alias("at"), "seq", F.col("body").isNotNull().alias("usable"))
    request = F.struct(*requests.columns)
    responses = stored.where(F.col("status").between(200, 299) & limited).select(
        "path", F.col("fetched_at").alias("at"), response.alias("stored"), F.lit(None).cast(requests.schema).alias("request")
    )
    asked = requests.where(limited).select("path", F.col("requested_at").alias("at"), F.lit(None).cast(responses.schema["stored"].dataType).alias("stored"), request.alias("request"))
    moments = responses.unionByName(asked).repartitionByRange("path", "at")
    moments = stored_rows(moments.withColumn("part", F.spark_partition_id()), "moments")

    # A response counts for requests of its very moment; of responses of one moment the later one counts.
    order = [F.col("at"), F.col("request").isNotNull(), F.col("stored.seq")]
    before = Window.partitionBy("part", "path").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = moments.withColumn("found", F.last("stored", ignorenulls=True).over(before)).where("request IS NOT NULL")
    handed = moments.groupBy("part", "path").agg(F.max("stored").alias("newest"))
    earlier = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = handed.select("part", "path", F.last("newest", ignorenulls=True).over(earlier).alias("carried")).where("carried IS NOT NULL")

    limit = ttl_seconds(endpoint(F.col("path")))
    hit = local.join(carried, ["part", "path"], "left").select("path", "at", "request", F.coalesce("found", "carried").alias("hit"))
    fresh = F.coalesce(F.col("hit.usable") & (F.unix_micros("at") < F.unix_micros("hit.at") + limit.cast("long") * _SECOND), F.lit(False))
    answered = hit.select("request.*", F.when(fresh, F.col("hit.seq")).alias("stored_seq"), F.when(fresh, F.col("hit.at")).alias("stored_at"))
    none = requests.where(~limited).withColumns({"stored_seq": F.lit(None).cast("bigint"), "stored_at": F.lit(None).cast("timestamp")})
    return answered.unionByName(none)
