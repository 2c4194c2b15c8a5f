"""How requests ended, from the attempt log a crawler leaves behind.

An attempt row is `(request_id, attempt, url, received_at, status, reason, failure, retry_after,
content_type, body)`; `failure` is `timeout` or `network` when there was no response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelake.functions import http


def outcome() -> Column:
    """ok, rate_limited, server_error, api_error, timeout or network."""
    status = F.col("status")
    return (
        F.when(F.col("failure") == "timeout", "timeout")
        .when(F.col("failure").isNotNull() | status.isNull(), "network")
        .when(status.between(200, 299), "ok")
        .when(status == http.TOO_MANY_REQUESTS, "rate_limited")
        .when(status >= http.SERVER_ERROR, "server_error")
        .otherwise("api_error")
    )


def classify(attempts: DataFrame) -> DataFrame:
    return attempts.withColumn("outcome", outcome())


def with_retry_rule(
    attempts: DataFrame, max_retries: int = http.MAX_RETRIES, respect_429: bool = True
) -> DataFrame:
    """May the attempt be tried again? Timeouts never are."""
    worth_it = F.col("outcome").isin("network", "server_error") | (
        (F.col("outcome") == "rate_limited") & F.lit(respect_429)
    )
    return classify(attempts).withColumn("retryable", worth_it & (F.col("attempt") < max_retries))


def with_retry_wait(
    attempts: DataFrame, max_retries: int = http.MAX_RETRIES, respect_429: bool = True
) -> DataFrame:
    """Bounds of the wait before a retry: the server's hint on a rate limit, else the backoff bounds."""
    low = F.coalesce(hint(), http.backoff_low(F.col("attempt")))
    high = F.coalesce(hint(), http.backoff_high(F.col("attempt")))
    ruled = with_retry_rule(attempts, max_retries, respect_429)
    return ruled.withColumns(
        {"wait_low": F.when(F.col("retryable"), low), "wait_high": F.when(F.col("retryable"), high)}
    )


def final_outcomes(attempts: DataFrame, *columns: str) -> DataFrame:
    """Last attempt of every request and how many there were; combines before the shuffle."""
    keep = columns or tuple(c for c in attempts.columns if c not in ("request_id", "attempt"))
    last = F.max_by(F.struct("attempt", *keep), F.col("attempt"))
    ended = attempts.groupBy("request_id").agg(last.alias("_l"), F.count(F.lit(1)).alias("attempts"))
    return classify(ended.select("request_id", "attempts", "_l.*"))


def successes(finals: DataFrame) -> DataFrame:
    """Responses for the lake."""
    return finals.where(F.col("outcome") == "ok")


def message() -> Column:
    """What a failed attempt is reported as."""
    return (
        F.when(F.col("outcome") == "timeout", F.concat(F.lit("request to "), F.col("url"), F.lit(" timed out")))
        .when(F.col("outcome") == "network", F.concat(F.lit("network error calling "), F.col("url")))
        .otherwise(
            http.error_message(F.col("status"), F.col("reason"), F.col("content_type"), F.col("body"))
        )
    )


def hint() -> Column:
    """The server's hint in seconds, for rate limits."""
    return F.when(
        F.col("outcome") == "rate_limited",
        http.retry_after_seconds(F.col("retry_after"), F.col("received_at")),
    )


def dead_letters(finals: DataFrame) -> DataFrame:
    """Requests that failed for good, with the message, and the server's hint for rate limits."""
    failed = finals.where(F.col("outcome") != "ok")
    return failed.select(
        "request_id",
        "attempts",
        "outcome",
        "status",
        "url",
        message().alias("message"),
        hint().alias("retry_after_seconds"),
    )


def landed(attempts: DataFrame) -> DataFrame:
    """Responses for the lake: the attempts that ended their request well, in the form of bronze rows.

    Which attempt was a request's last is found by numbers alone; bodies meet that answer in a join on the request and
    the attempt, of which only good attempts are a part.
    """
    last = attempts.groupBy("request_id").agg(F.max("attempt").alias("attempt"))
    good = classify(attempts).where(F.col("outcome") == "ok")
    ended = good.join(last, ["request_id", "attempt"])
    return ended.select(
        F.col("request_id").alias("seq"), F.col("url").alias("path"), F.col("received_at").alias("fetched_at"), "status", "content_type", "body"
    )
