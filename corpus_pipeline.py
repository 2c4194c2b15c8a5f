"""From raw documents to packed training sequences: five stages, each written and reread between.

Stages decide by doc_id: a row goes when every row of its id is to go. Rows without an id share one decision, too.
Null and empty texts have no letter and go in the first stage; columns beyond those of documents are carried along.
Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelake.llm import exact_dedup, jaccard_join, language_id, packing, source_mixing
from queuelake.llm.shared import BROADCAST_IDS, documents, stored
from queuelake.session import prepare


def _without(docs: DataFrame, decisions: DataFrame, stays: str) -> DataFrame:
    """Documents but for those whose id has only decisions to go; the ids travel while they are few enough."""
    goes = stored(decisions.groupBy("doc_id").agg(F.max(F.expr(stays)).alias("stays")).where("NOT stays").select(F.col("doc_id").alias("gone")), "pipeline-gone")
    goes = F.broadcast(goes) if goes.count() <= BROADCAST_IDS else goes
    return docs.join(goes, docs["doc_id"].eqNullSafe(goes["gone"]), "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language model accepts go."""
    return _without(docs, language_id.identify(docs), "NOT rejected")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, and one row of rows that repeat an id and a text."""
    rest = _without(docs, exact_dedup.exact_groups(docs), "kept")
    twice = stored(docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("doc_id").alias("twice")), "pipeline-twice")
    if twice.isEmpty():
        return rest
    same = rest["doc_id"].eqNullSafe(twice["twice"])
    return rest.join(twice, same, "left_anti").union(rest.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays."""
    return _without(docs, jaccard_join.near_duplicates(docs), "component_id <=> doc_id")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at mixed weights: every document once or more, as often as its source's weight asks."""
    return source_mixing.mix(docs).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack_documents(docs, keep_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Language models, tokenizers and first-fit packing have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(prepare(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
