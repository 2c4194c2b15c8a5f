"""Mixing sources by temperature, with DataFrame functions alone.

Each source's share of the tokens is raised to an exponent and normalised. The exponent is bisected: the smallest
(flattest weights) at which no source is repeated more than `repetition_limit` times and the entropy of the weights
stays within `target_entropy`. The budget lets the source that is repeated least pass exactly once, so no document is
lost. A source's documents lie in blocks, by a hash; whole passes take all blocks, and the pass that the budget cuts
takes blocks in a permuted order as long as tokens are left, and of the last one its first documents. Blocks have a
bounded size, so no task sorts a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from queuelake.llm.shared import stored

REPETITION_LIMIT = 2.0
BLOCK_TOKENS = 1 << 20
_STEPS, _SHARPEST = 60, 8.0
#: Most rows of a table of sources or blocks that is sent to every executor; a larger one is joined by a shuffle.
_BROADCAST_ROWS = 500_000
WORD = r"[^\x20\x09-\x0D]+"


def _hash(*parts: Column | str) -> Column:
    """60 bits of the MD5 of parts joined by colons: the same number in any engine."""
    text = F.concat_ws(":", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _sent(facts: DataFrame, name: str) -> DataFrame:
    """A small table stored once, and sent along to the documents while its size allows."""
    facts = stored(facts, name)
    return F.broadcast(facts) if facts.count() <= _BROADCAST_ROWS else facts


def exponent(sources: DataFrame, repetition_limit: float | None, target_entropy: float | None) -> float:
    """Bisected over the array of shares, one number for each source."""
    shares = sources.agg(F.sort_array(F.collect_list(F.col("tokens").cast("double"))).alias("t"))
    shares = shares.select(F.transform("t", lambda x: x / F.aggregate("t", F.lit(0.0), lambda s, y: s + y)).alias("s"))

    def fits(a: Column) -> Column:
        ok = F.lit(True)
        if repetition_limit is not None:
            # Weights over shares, largest over smallest: how often the most repeated source passes.
            ratio = lambda x: F.pow(x, a - 1)
            ends = F.array(ratio(F.element_at("s", 1)), ratio(F.element_at("s", -1)))
            ok = ok & (F.array_max(ends) / F.array_min(ends) <= repetition_limit)
        if target_entropy is not None:
            total = F.aggregate("s", F.lit(0.0), lambda t, x: t + F.pow(x, a))
            entropy = F.aggregate("s", F.lit(0.0), lambda t, x: t - F.pow(x, a) / total * F.log(F.pow(x, a) / total))
            ok = ok & (entropy <= F.lit(target_entropy) + 1e-12)
        return ok

    # At 1 nothing is repeated; only an entropy below that of the shares needs more.
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0 if target_entropy is None else _SHARPEST).alias("hi"))

    def halve(at: Column, _: Column) -> Column:
        middle = (at["lo"] + at["hi"]) / 2
        fit = fits(middle)
        return F.struct(F.when(fit, at["lo"]).otherwise(middle).alias("lo"), F.when(fit, middle).otherwise(at["hi"]).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)), start, halve)["hi"]
    row = shares.where(F.size("s") > 0).select(F.when(fits(F.lit(0.0)), 0.0).otherwise(found)).first()
    return row[0] if row else 1.0


def mix(docs: DataFrame, repetition_limit: float | None = REPETITION_LIMIT, target_entropy: float | None = None, block_tokens: int = BLOCK_TOKENS, seed: str = "mix") -> DataFrame:
    """The documents of the mixture: all columns of `docs`, a row for each pass of a document, and three more.

    mix_copy numbers the passes of a document from 0, mix_block is its block in the source, mix_place (0 to 1) says
    where in the mixed stream its block comes, sources interleaved. (Columns of these names in `docs` are replaced.)
    Tokens are words and one end, so null and empty texts have one. Null and empty sources are one source. Rows that
    repeat a doc_id take the same decision; a null doc_id counts as empty text. One source passes once. No rows give
    no rows. target_entropy is in nats.
    """
    named = docs.drop("mix_copy", "mix_block", "mix_place")
    source = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source")
    words = (F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)) + 1).cast("bigint")
    turn = _hash(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    small = docs.select(source, words.alias("_tokens"), turn.alias("_turn"))
    sources = small.groupBy("_source").agg(F.sum("_tokens").alias("tokens"))
    a = exponent(sources, repetition_limit, target_entropy)
    # Passes of a source: its weight over its share, relative to the source that passes least.
    relative = F.pow(F.col("tokens").cast("double"), F.lit(a) - 1)
    least = sources.select(relative.alias("x")).agg(F.min("x")).first()[0]
    passes = (relative / F.lit(least or 1.0)).alias("passes")
    sources = sources.select("_source", "tokens", passes, F.ceil(F.col("tokens") / block_tokens).cast("bigint").alias("blocks"))
    sources = sources.withColumn("whole", F.floor(F.col("passes") + 1e-9)).withColumn("budget", F.round((F.col("passes") - F.col("whole")) * F.col("tokens")).cast("bigint"))

    sources = _sent(sources, "mix-sources")

    block = F.pmod("_turn", "blocks").alias("_block")
    placed = small.join(sources, "_source").select("_source", "_tokens", "_turn", block, "whole", "passes", "budget", "tokens")
    blocks = placed.groupBy("_source", "_block", "whole", "passes", "budget", "tokens").agg(F.sum("_tokens").alias("size"))
    order = _hash(seed, F.col("_source"), F.col("_block"))
    before = F.sum("size").over(W.partitionBy("_source").orderBy("order", "_block")) - F.col("size")
    blocks = blocks.withColumn("order", order).withColumn("before", before)
    cut = blocks.where((F.col("before") < F.col("budget")) & (F.col("before") + F.col("size") > F.col("budget")))
    inside = placed.select("_source", "_block", "_tokens", "_turn").join(cut.select("_source", "_block", "before", "budget"), ["_source", "_block"])
    inside = inside.groupBy("_source", "_block", "before", "budget", "_turn").agg(F.sum("_tokens").alias("_tokens"))
    reached = F.sum("_tokens").over(W.partitionBy("_source", "_block").orderBy("_turn")) - F.col("_tokens") + F.col("before")
    last = inside.withColumn("reached", reached).where("reached < budget").groupBy("_source", "_block").agg(F.max("_turn").alias("last"))
    limit = F.when(F.col("before") >= F.col("budget"), -1).when(F.col("before") + F.col("size") <= F.col("budget"), (1 << 62)).otherwise(F.col("last"))
    blocks = blocks.join(last, ["_source", "_block"], "left").select("_source", "_block", "whole", "passes", "tokens", "before", F.coalesce(limit, F.lit(-1)).cast("bigint").alias("limit"))

    blocks = _sent(blocks, "mix-blocks")

    every = named.select(F.struct(*named.columns).alias("_row"), source, turn.alias("_turn")).join(sources.select("_source", "blocks"), "_source").withColumn("_block", F.pmod("_turn", "blocks"))
    every = every.join(blocks, ["_source", "_block"])
    copies = F.sequence(F.lit(0), (F.col("whole") - 1 + F.when(F.col("_turn") <= F.col("limit"), 1).otherwise(0)).cast("int"))
    out = every.select("_row", "_block", "passes", "tokens", "before", F.explode(copies).alias("mix_copy"))
    place = F.round((F.col("mix_copy") + F.col("before") / F.col("tokens")) / F.col("passes"), 6)
    return out.select("_row.*", "mix_copy", F.col("_block").alias("mix_block"), place.alias("mix_place"))
