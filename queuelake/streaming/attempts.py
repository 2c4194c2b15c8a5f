"""Following the attempt log: how a request ended, told once no retry can come any more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.operators import attempts as log

#: How long after an attempt the next may come: the longest backoff, and a request that takes its whole time.
PATIENCE_SECONDS = 20


def final_outcomes(attempts: DataFrame, delay: str, patience_seconds: int = PATIENCE_SECONDS, at: str = "received_at") -> DataFrame:
    """Final outcome of every request of a stream of attempts, a row each, when its time is over.

    Attempts of a request are one session: each holds it open for the patience, or for as long as the server's hint
    asks and the patience on top. A session ends when the watermark, `delay` behind the newest attempt, has passed it; then
    its row is emitted and its state dropped. The state of an open request is its newest attempt with the message in
    the place of the body. Attempts that come after their session has ended are dropped by the watermark; the stored
    outcomes tell which (`late_attempts`).
    """
    told = log.classify(attempts).withColumn("hint", log.hint())
    seconds = F.ceil(F.greatest(F.coalesce("hint", F.lit(0.0)), F.lit(0.0))) + patience_seconds
    rows = told.select(
        "request_id", "attempt", "status", "outcome", "url", log.message().alias("message"), "hint", F.col(at).alias("at"), seconds.alias("seconds")
    )
    session = F.session_window("at", F.concat(F.col("seconds").cast("string"), F.lit(" seconds")))
    last = F.max_by(F.struct("attempt", "status", "outcome", "url", "message", "hint"), "attempt")
    ended = rows.withWatermark("at", delay).groupBy("request_id", session.alias("open")).agg(
        last.alias("l"), F.count(F.lit(1)).alias("attempts"), F.collect_set("attempt").alias("counted")
    )
    return ended.select(
        "request_id", "attempts", F.array_sort("counted").alias("counted"), "l.attempt", "l.status", "l.outcome", "l.url", "l.message",
        F.col("l.hint").alias("retry_after_seconds"), F.col("open.start").alias("opened_at"), F.col("open.end").alias("closed_at"),
    )


def dead_letters(outcomes: DataFrame) -> DataFrame:
    """Of stored outcomes, the requests that failed for good."""
    failed = outcomes.where(F.col("outcome") != "ok")
    return failed.select("request_id", "attempts", "outcome", "status", "url", "message", "retry_after_seconds")


def late_attempts(attempts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Attempts of a log that no stored outcome counts, of requests that have one: those that came too late."""
    counted = outcomes.select("request_id", F.explode("counted").alias("attempt"))
    told = attempts.join(outcomes.select("request_id").distinct(), "request_id", "left_semi")
    return told.join(counted, ["request_id", "attempt"], "left_anti")
