"""From raw documents to packed training sequences: the operators in the order a corpus needs them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm import exact_dedup, jaccard_join, packing, quality_rules, toxicity
from annalist.llm.frames import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 under a model of the labels of these documents."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.without_low_quality(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.without_similar(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, each at its place in a training sequence of 1024 ids.

    ``packing.sequences`` joins the pieces of a sequence into one row.
    """
    placed = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)
    return placed.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc32").alias("ids_crc32"), "sequence_id", "offset", F.col("ids").alias("input_ids")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack),
]

#: Neither the learned scores nor the tokenizer are SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each on a written table of what the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
