"""Corpus pipeline: quality rules, quality classifier, near-duplicate join, packing.

Each stage works on all rows that the one before kept and is stored before the next reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import jaccard, packing, quality_classifier, quality_rules
from tickweave.session import shared_root


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outlier of their language and source."""
    return quality_rules.judge(docs).where("kept").select(*docs.columns)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is below their language's threshold."""
    return quality_classifier.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("kept").select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component of near copies: that of the smallest id (null last), of its copies the smallest row.

    Decided on rows: a row's key is a 64-bit hash of its id and text, the same whenever it is read, so that texts that repeat an id and
    texts without one are told apart. Texts without words link with nothing and all stay.
    """
    # A null id and a null text are told from all others by their marks.
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    worded = docs.where(F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))).withColumn("row_key", key)
    near = jaccard.near_duplicates(worded.select(F.col("row_key").alias("doc_id"), "text")).select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    ids = worded.select("row_key", "doc_id").distinct()
    stay = near.join(ids, "row_key").groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("m")) \
        .select(F.col("m.row_key").alias("row_key"))
    # Rows with the same id and text become one.
    kept = worded.join(stay, "row_key", "left_semi").groupBy("row_key").agg(F.min(F.struct(*docs.columns)).alias("m")).select("m.*")
    return kept.union(docs.where(~F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)))).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its bin and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_duplicates", near_duplicates_stage),
    ("packing", packing_stage),
]
#: The classifier and the packing are not for SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
