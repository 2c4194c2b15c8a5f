"""Loose lookup in a directory: rows with `ord`, `slug`, `name` and whatever else they carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelake.functions.text import loosely_matches, normalize


def find(directory: DataFrame, query: str | Column, *order: str) -> DataFrame:
    """First row, in list order, whose slug or name contains the query; no row for a blank query."""
    needle = normalize(F.lit(query) if isinstance(query, str) else query)
    hits = directory.where(loosely_matches(needle, F.col("slug"), F.col("name")))
    return hits.orderBy(*(order or ("ord",))).limit(1)


#: Characters of the pieces that needles are filed under; shorter needles are pieces themselves.
GRAM = 3


def _pieces(text: Column, width: int) -> Column:
    """Distinct pieces of `width` characters; none of a shorter text."""
    starts = F.when(F.length(text) >= width, F.sequence(F.lit(1), F.length(text) - width + 1))
    return F.array_distinct(F.transform(starts, lambda at: F.substring(text, at, F.lit(width))))


def candidates(labels: DataFrame, needles: DataFrame) -> DataFrame:
    """Pairs `(needle, label)` that may match, and all that do, from distinct labels and distinct needles.

    A needle is filed under the one of its pieces of GRAM characters that the fewest labels have, or under itself if
    it is shorter. A label looks up its own pieces, so it meets the needles of the rare pieces it has, not all needles
    and not once per length of needles.
    """
    of_label = None
    for width in range(1, GRAM + 1):
        part = labels.select("label", F.explode(_pieces(F.col("label"), width)).alias("piece"))
        of_label = part if of_label is None else of_label.unionByName(part)
    width = F.length("needle")
    parts = F.when(width < GRAM, F.array("needle")).otherwise(_pieces(F.col("needle"), GRAM))
    of_needle = needles.select("needle", F.explode(parts).alias("piece"))
    listed = of_label.groupBy("piece").agg(F.count(F.lit(1)).alias("labels"))
    # A piece that no label has is the rarest of all: its needles match nothing.
    rarity = of_needle.join(listed, "piece", "left").select("needle", F.struct(F.coalesce("labels", F.lit(0)).alias("labels"), "piece").alias("p"))
    filed = rarity.groupBy("needle").agg(F.min("p").alias("p")).where("p.labels > 0").select("needle", "p.piece")
    return of_label.join(filed, "piece").select("needle", "label")


def find_many(directory: DataFrame, queries: DataFrame) -> DataFrame:
    """`find` for every row of `queries(q)`: each query with its first match, or nulls.

    No query meets every directory row: queries and labels meet by the rarest piece of a query (`candidates`), and
    only such pairs are compared. Labels repeated over many rows are reduced to their first `ord` beforehand, and
    matches to the first `ord` per query with a map-side combine. `ord` must be unique in the directory.
    """
    normalized = queries.select("q", normalize(F.col("q")).alias("needle"))
    needles = normalized.where(F.length("needle") > 0).select("needle").distinct()
    labels = directory.select(
        "ord", F.explode(F.array(normalize(F.col("slug")), normalize(F.col("name")))).alias("label")
    )
    labels = labels.where(F.length("label") > 0).groupBy("label").agg(F.min("ord").alias("ord"))
    met = candidates(labels.select("label"), needles).where(F.contains("label", F.col("needle")))
    first = met.join(labels, "label").groupBy("needle").agg(F.min("ord").alias("ord"))
    answers = first.join(directory, "ord")
    return normalized.join(answers, "needle", "left").drop("needle")
