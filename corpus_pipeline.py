"""From raw documents to packed training sequences: five stages of the corpus operators.

Every stage reads what its predecessor wrote. All but the last return the columns of documents,
extra ones included, with their decisions applied to the rows and texts.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm import line_dedup, mixing, near_copies, packing, toxicity
from kerbside.llm.common import table
from kerbside.llm.queries import OTHER_WEIGHT, TOKENIZER, WEIGHTS
from kerbside.shared import shared_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon does not call toxic."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document with a larger id keeps for them."""
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    kept = line_dedup.drop_shared_lines(docs)
    return kept.select(*[
        F.when(F.col("n_dropped") > 0, changed[c]).otherwise(F.col(f"row.`{c}`")).alias(c)
        if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns
    ])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id. Documents are linked by
    SimHash (op2's rule) and by a 5-word Jaccard similarity of 0.8 or more, which finds more.

    Documents without an id stay; of rows repeated under one id one stays.
    """
    found = near_copies.near_copies(docs)
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64("text").alias("h"))
    kept = (
        rows.join(first, "id", "left_semi")
        .withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy("h")))
        .where("nth = 1").select("row")
    )
    return kept.unionByName(rows.where("id is null").select("row")).select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources meet their target weights, in random order."""
    return mixing.mix(docs, WEIGHTS, OTHER_WEIGHT).select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.best_fit(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash", simhash_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# Learned scores, fingerprints and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written to the shared folder for the next one."""
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_dir(spark)}/kerbside-llm/{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
