"""The corpus pipeline: documents are judged, cleaned of toxic and near-duplicate texts, and packed.

Every stage is a function of (spark, docs, sf_dir). All but the last return the columns of ``docs``,
whatever they are named: the rows travel beside what an operator adds. Rows keep their values; stages
only leave rows out. Null or empty texts go with the quality rules, since they have no words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketspark.llm import neardup, packing, quality, sharding, toxicity
from ticketspark.llm.registry import table
from ticketspark.session import materialize

#: A text with at least this score goes.
TOXIC = 0.7


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    return quality.passed(rows).select("doc.*")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model learned from the labelled documents of ``sf_dir``."""
    model = toxicity.learn_from(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    return toxicity.score_texts(rows, model).where(F.col("score") < TOXIC).select("doc.*")


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word runs, 0.8): the smallest doc_id.

    Rows with a null doc_id belong to no group and stay. Of rows that repeat both doc_id and text one
    stays. Different texts of one doc_id are judged each for itself, so a doc_id may stay with several.
    """
    rows, ids = docs.agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    if rows == ids:
        return _without_near_copies(docs)
    doc, digest = F.struct(*docs.columns).alias("doc"), F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))
    named = docs.where(F.col("doc_id").isNotNull()).select(doc, F.col("doc_id").cast("long").alias("id"), digest.alias("digest"))
    # numbered by doc_id first, so that a group's smallest number has its smallest doc_id
    numbers = sharding.number_rows(named.select("id", "digest").distinct(), ["id", "digest"], "number")[0]
    once = named.dropDuplicates(["id", "digest"]).join(numbers, ["id", "digest"])
    once = materialize(once.select("doc", F.col("number").alias("doc_id"), F.col("doc.text").alias("text")), "numbered-texts")
    return _without_near_copies(once).select("doc.*").unionByName(docs.where(F.col("doc_id").isNull()))


def _without_near_copies(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, whose doc_ids are distinct or null, that are kept."""
    found = materialize(neardup.near_duplicates(docs, width=5, percent=80), "near-duplicates")
    dropped = found.where(F.col("doc_id").isNotNull() & ~F.col("kept")).select("doc_id").distinct()
    return neardup.having(docs, dropped, "doc_id", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens lie in sequences of 4096."""
    pieces = packing.tokenize(docs, packing.default_path(), with_ids=False)
    return packing.pack(pieces, ["doc_id", "start", "ids_crc32"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicate_filter),
    ("packing", packed),
]

#: Compression scores and tokens are not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
