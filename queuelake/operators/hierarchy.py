"""Descendants over parent links, for when only entity rows are at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.session import stored


def descendant_closure(edges: DataFrame) -> DataFrame:
    """All `(root_id, id, depth)` with `id` below `root_id`, from rows `(id, parent_id)`.

    The climb runs over parents only, which are few next to the leaves, by jumps that double: after round k every
    ancestor up to 2^k levels above is known, so a chain of a thousand takes ten rounds. A pair is found once, as a jump
    of 2^k and the way from there. Rounds are stored in the shared folder, so a lost executor repeats one, not the
    climb. The whole edge table is joined once, at the end, each edge to the ancestors of its parent. Edges that
    several polls repeat count once. Raises on a cycle, which shows when a node turns up as its own ancestor.
    """
    linked = edges.where(F.col("parent_id").isNotNull()).select("id", "parent_id").distinct()
    parents = linked.select(F.col("parent_id").alias("node")).distinct()
    climb = linked.join(parents, F.col("id") == F.col("node")).select("node", F.col("parent_id").alias("root_id"), F.lit(1).alias("depth"))
    found = stored(climb, "climb")
    reach, jumps, far = found, found, 1
    while not found.isEmpty():
        if not found.where("node = root_id").isEmpty():
            raise ValueError("parent links are cyclic")
        onward = reach.select(F.col("node").alias("via"), F.col("root_id"), (F.col("depth") + far).alias("depth"))
        found = stored(jumps.select("node", F.col("root_id").alias("via")).join(onward, "via").select("node", "root_id", "depth"), "climb")
        reach, far = reach.unionByName(found), 2 * far
        jumps = found.where(F.col("depth") == far)
    reach = parents.select("node", F.col("node").alias("root_id"), F.lit(0).alias("depth")).unionByName(reach)
    return linked.join(reach, F.col("parent_id") == F.col("node")).select("root_id", "id", (F.col("depth") + 1).alias("depth"))


def below(closure: DataFrame, root_id: str) -> DataFrame:
    """Everything below one root."""
    return closure.where(F.col("root_id") == root_id).select("id", "depth")
