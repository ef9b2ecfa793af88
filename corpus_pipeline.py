"""The corpus pipeline: stages that call the operators, each on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanload.llm import bpe, minhash, mixing, quality
from spanload.llm.common import read_table, stage
from spanload.llm.q_corpus import domains
from spanload.llm.q_text import VOCABULARY
from spanload.llm.text_model import row_key


#: Junk is gone by then and left free; toxic texts are thinned out.
TARGETS = {"good": 0.95, "toxic": 0.05}


def _matching(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with decisions by ``row_key``, which are distinct by it."""
    key = row_key(F.col("doc_id"), F.col("text"))
    return docs.withColumn("row_key", key).join(decisions, "row_key", how).drop("row_key")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    Each row is judged by its own id and text; repeated rows stay or go together, and a
    probability of just one half stays.  Null and empty texts are judged by their features, null
    ids have no label.  No labels: all stay; an empty table stays empty.
    """
    judged = quality.classify(docs, read_table(spark, sf_dir, "labels"))
    return _matching(docs, judged.where("kept").select("row_key"), "left_semi")


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, similarity 0.8.

    Rows are compared by their own text, whatever their ids, null ones too; of a group the
    least id stays (null last).  Rows of one id and one text are one row, null and empty
    texts of an id alike; texts without words are no near copies of others.
    """
    rows = stage(docs.withColumn("row_key", row_key(F.col("doc_id"), F.col("text"))).dropDuplicates(["row_key"]),
                 "distinct-rows")
    groups = minhash.near_duplicates(rows.select("row_key", "text"), words=5, percent=80, doc="row_key")
    first = (groups.select(F.col("doc_id").alias("row_key"), "component_id").join(rows.select("row_key", "doc_id"), "row_key")
             .groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("least")))
    return rows.join(first.select("least.row_key"), "row_key", "left_semi").drop("row_key")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says; good ones are never thinned out.

    A rate between whole numbers is rounded by a hash of the row's id and text, so repeated rows come
    as often each.  Null and empty texts have no tokens and rates of their own; null ids have no label.
    No labels or tokens: every row once; an empty table stays empty.
    """
    rates = mixing.mix(docs, domains(spark, sf_dir), TARGETS, whole="good")
    copies = rates.select("row_key", "copies").distinct()
    taken = _matching(docs, copies, "inner").where("copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "_copy")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding gave the text back.

    Null and empty texts have no ids; rows, repeated or not, all come back; null ids stay null.
    """
    ids = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN)
    both = bpe.decode(ids, VOCABULARY, public_tokenizers.PATTERN)
    exact = F.coalesce("text", F.lit("")).cast("binary") == F.col("decoded")
    return both.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       exact.alias("exact"))


STAGES = [("quality", good), ("near_dedup", unique), ("mixing", mixed), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
