"""Data-quality checks over the current documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.functions.text import is_blank

# Default limits of the checks and alerts.
MIN_TEXT_LENGTH = 50
ALERT_SCORE = 95.0
ALERT_SAVED_PERCENT = 70.0
CHECKS = ["empty_title", "missing_text", "invalid_status", "short_text"]


def valid_statuses(dictionary: DataFrame) -> DataFrame:
    """Distinct status ids each source defines."""
    return (
        dictionary.filter("is_current AND dict_type = 'status'")
        .select("source", F.col("entry_id").alias("status_id"))
        .distinct()
    )


def flag_documents(documents: DataFrame, statuses: DataFrame, min_length: int = MIN_TEXT_LENGTH) -> DataFrame:
    """Add one boolean per check. A null status passes, a length of 0 is not short."""
    known = statuses.select("source", "status_id", F.lit(True).alias("_known"))
    length = F.col("text_length")
    return (
        documents.join(known, ["source", "status_id"], "left")
        .withColumn("empty_title", is_blank(F.col("title")))
        .withColumn("missing_text", ~F.coalesce("has_text", F.lit(False)))
        .withColumn("invalid_status", F.col("status_id").isNotNull() & F.col("_known").isNull())
        .withColumn("short_text", F.coalesce((length > 0) & (length < min_length), F.lit(False)))
        .drop("_known")
    )


def invalid_status_rows(documents: DataFrame, statuses: DataFrame) -> DataFrame:
    return documents.filter(F.col("status_id").isNotNull()).join(
        statuses.select("source", "status_id"), ["source", "status_id"], "left_anti"
    )


def check_counts(flagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    return flagged.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total_documents"), *[F.count_if(F.col(c)).alias(c) for c in CHECKS]
    )


def quality_score(counts: DataFrame) -> DataFrame:
    """Add the score: share of documents left after taking off empty titles and
    invalid statuses. A document failing both is taken off twice; 0 if none."""
    good = F.col("total_documents") - F.col("empty_title") - F.col("invalid_status")
    score = good / F.nullif(F.col("total_documents"), F.lit(0)) * 100
    return counts.withColumn("quality_score", F.round(F.coalesce(score, F.lit(0.0)), 2))


def pass_rates(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per check with passed, failed and the rate in percent."""
    pairs = ", ".join(f"'{c}', {c}" for c in CHECKS)
    passed = F.col("total_documents") - F.col("failed")
    return counts.select(
        *(by or []), "total_documents", F.expr(f"stack({len(CHECKS)}, {pairs}) AS (check_name, failed)")
    ).select(
        *(by or []),
        "check_name",
        passed.alias("passed"),
        "failed",
        F.round(passed / F.nullif(F.col("total_documents"), F.lit(0)) * 100, 2).alias("pass_rate"),
    )


def alerts(scores: DataFrame, saved: DataFrame) -> DataFrame:
    """Sources whose score or saved share is below its limit."""
    low_score = F.when(F.col("quality_score") < ALERT_SCORE, F.lit("low quality score"))
    low_saving = F.when(F.col("saved_percent") < ALERT_SAVED_PERCENT, F.lit("few fetches saved"))
    return (
        scores.select("source", "quality_score")
        .join(saved.select("source", "saved_percent"), "source", "left")
        .withColumn("alert", F.explode(F.array_compact(F.array(low_score, low_saving))))
    )
