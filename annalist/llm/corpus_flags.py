"""Quality flags of a corpus: the union of all reasons of the curation filters, near duplicates and perplexity included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm import jaccard_join
from annalist.llm.frames import stage
from annalist.operators import curation
from checks.curation_queries import languages, scores
from checks.registry import Tables

#: The connected groups of near copies are not SQL; a test compares with a brute-force version.
ORACLE_SQL = None


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id`` of documents that links of near copies connect with a smaller one."""
    found = jaccard_join.similar(documents, threshold=curation.NEAR_SIMILARITY)
    return found.where(F.col("class_id") < F.col("id")).select(F.col("id").alias("doc_id"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    near = stage(near_duplicates(t.documents.select("doc_id", "text")), "near-duplicates")
    flags = curation.quality_flags(t.texts, ["source"], scores=stage(scores(t), "perplexities"), near=near, languages=languages(t))
    return flags.select("doc_id", F.concat_ws(",", "quality_flag").alias("quality_flag"))
