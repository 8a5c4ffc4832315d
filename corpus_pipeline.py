"""A corpus made ready for training: five stages over `documents`, each a call of one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import decontaminate, exact, jaccard, packing, toxicity
from assay.llm.queries import CATEGORIES, END_ID, SEQUENCE, graded, table
from assay.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the classifier chain calls toxic."""
    return toxicity.drop_flagged(docs, graded(table(spark, sf_dir, "labels")), CATEGORIES, "toxic")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with one text the one with the largest doc_id."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one row, of the least doc_id; null keys come last."""
    # The numbers are written, because they must be the same in both readings.
    numbered = settle(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    one = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row")
    linked = jaccard.link_documents(numbered.select(one.alias("doc_id"), "text"))
    first = linked.where(F.col("doc_id") == F.col("component_id")).select("doc_id._row")
    return numbered.join(first, "_row", "left_semi").drop("_row")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of which benchmark windows cover a twentieth or more."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    found = decontaminate.search(rows, table(spark, sf_dir, "benchmark"), key="row")
    return decontaminate.judge(found, key="row").where(~F.col("contaminated")).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(docs, ranks, public_tokenizers.PATTERN, END_ID, SEQUENCE, added=added)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

#: Classifiers, tokenizers and packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each on what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
