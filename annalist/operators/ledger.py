"""Ledger of collection runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.operators.chains import newest_per_key
from annalist.operators.history import at

ACTION_COUNTS = ["documents_new", "documents_updated", "documents_unchanged"]
COUNTS = ["documents_found", "documents_new", "documents_updated", "documents_unchanged", "documents_failed"]


def run_status(failed: Column, completed_at: Column) -> Column:
    return F.when(completed_at.isNull(), "running").when(failed == 0, "success").otherwise("partial")


def run_rows(
    listed: DataFrame,
    actions: DataFrame,
    failed: DataFrame,
    documents: DataFrame,
    run_id: str,
    started_at: str,
    completed_at: str,
    sources: Sequence[str] = (),
    first: DataFrame | None = None,
) -> DataFrame:
    """One ledger row per source, from the counts each step left.

    ``listed`` and ``failed`` hold one row per record, ``actions`` one row per
    merged record, ``documents`` the current rows after the merge. Sources named
    in ``sources`` have a row even if they listed nothing. ``first`` holds rows
    of runs that finished before: a run repeated after its commit merges nothing
    new, so the actions counted then are kept.
    """
    found = listed.groupBy("source").agg(F.count(F.lit(1)).alias("documents_found"))
    if sources:
        named = listed.sparkSession.createDataFrame([(s,) for s in sources], "source STRING")
        found = found.join(named, "source", "full")
    merged = actions.groupBy("source").agg(
        F.count_if(F.col("action") == "insert").alias("documents_new"),
        F.count_if(F.col("action") == "update").alias("documents_updated"),
        F.count_if(F.col("action") == "unchanged").alias("documents_unchanged"),
    )
    lost = failed.groupBy("source").agg(F.count(F.lit(1)).alias("documents_failed"))
    texts = documents.groupBy("source").agg(
        F.count_if(F.col("has_text")).alias("documents_with_text"),
        F.sum(F.col("text_length").cast("long")).alias("total_text_length"),
        F.sum(F.col("word_count").cast("long")).alias("total_word_count"),
    )
    # The four inputs are one row per source here, so these joins are small.
    joined = found.join(merged, "source", "left").join(lost, "source", "left").join(texts, "source", "left")
    numbers = [*COUNTS, "documents_with_text", "total_text_length", "total_word_count"]
    counted = joined.select(
        F.concat(F.lit(f"{run_id}_"), F.col("source")).alias("run_id"),
        "source",
        at(started_at).alias("started_at"),
        at(completed_at).alias("completed_at"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.lit(None).cast("string").alias("error_message"),
    ).withColumn("status", run_status(F.col("documents_failed"), F.col("completed_at")))
    if first is None:
        return counted
    kept = first.filter(F.col("status") != "running").select("run_id", *[F.col(c).alias(f"_{c}") for c in ACTION_COUNTS])
    counted = counted.join(kept, "run_id", "left")
    return counted.withColumns({c: F.coalesce(f"_{c}", c) for c in ACTION_COUNTS}).drop(*[f"_{c}" for c in ACTION_COUNTS])


def running_rows(spark: SparkSession, sources: Sequence[str], run_id: str, started_at: str) -> DataFrame:
    """Ledger rows of a run that has begun: no counts, no end."""
    rows = spark.createDataFrame([(f"{run_id}_{s}", s) for s in sources], "run_id STRING, source STRING")
    numbers = [*COUNTS, "documents_with_text", "total_text_length", "total_word_count"]
    return rows.select(
        "run_id",
        "source",
        at(started_at).alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        F.lit("running").alias("status"),
        *[F.lit(0).cast("long").alias(c) for c in numbers],
        F.lit(None).cast("string").alias("error_message"),
    )


def upsert(stored: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Replace the rows whose key recurs, keep the others: a retry does not clash."""
    return stored.join(rows.select(*keys), keys, "left_anti").unionByName(rows)


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest run of all."""
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1)


def latest_run_per_source(runs: DataFrame) -> DataFrame:
    return newest_per_key(runs, ["source"], ["started_at", "run_id"])


def daily_summary(runs: DataFrame) -> DataFrame:
    return runs.groupBy(F.to_date("started_at").alias("day")).agg(
        F.count_if(F.col("status") == "success").alias("runs_successful"),
        F.count_if(F.col("status") != "success").alias("runs_not_successful"),
        *[F.sum(c).alias(c) for c in COUNTS],
    )


def success_rate(runs: DataFrame, days: int = 7) -> DataFrame:
    """Share of successful runs in the ``days`` days up to and including each day.

    Runs are counted per source and day first; each day's counts then go to the
    ``days`` windows they belong to, so no window gathers a source's whole life.
    """
    daily = runs.groupBy("source", F.to_date("started_at").alias("_day")).agg(
        F.count_if(F.col("status") == "success").alias("_good"), F.count(F.lit(1)).alias("_all")
    )
    present = daily.select("source", F.col("_day").alias("day"))
    spread = daily.select(
        "source", F.explode(F.sequence("_day", F.date_add("_day", days - 1))).alias("day"), "_good", "_all"
    )
    return (
        spread.join(present, ["source", "day"], "left_semi")
        .groupBy("source", "day")
        .agg(F.sum("_all").alias("runs"), F.round(F.sum("_good") / F.sum("_all") * 100, 2).alias("success_percent"))
    )
