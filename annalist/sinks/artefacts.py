"""Temporary artefacts, reports and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_artefact(df: DataFrame, root: str, day: str, run_id: str, task: str) -> str:
    """JSON below ``date=/run_id=/task_``; a retry of the same run replaces it."""
    path = f"{root}/date={day}/run_id={run_id}/task_{task}"
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_snapshot(snapshot: DataFrame, root: str) -> str:
    """One folder per source, date and dictionary type."""
    path = f"{root}/snapshots"
    parts = ["source", "date", "dict_type"]
    (
        snapshot.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy(*parts)
        .json(path)
    )
    return path


def collection_report(
    run: DataFrame, statistics: DataFrame, created_at: str, left_out: DataFrame | None = None, filtering: DataFrame | None = None
) -> DataFrame:
    """One nested JSON document per run; run and statistics hold one row per source.

    With ``left_out``, pages of the list that do not count, the report has their
    number, that of their records, and that of pages whose records are unknown.
    ``filtering`` holds one :func:`filter_summary` row per source.
    """
    joined = run.drop("total_text_length", "total_word_count", "documents_with_text").join(statistics, "source", "left")
    counts = [c for c in run.columns if c.startswith("documents_") and c != "documents_with_text"]
    numbers = [c for c in statistics.columns if c != "source"]
    extra = []
    if left_out is not None:
        of_pages = {"pages": F.count(F.lit(1)), "records": F.sum("records"), "unreadable_pages": F.count_if(F.col("records").isNull())}
        joined = joined.join(left_out.groupBy("source").agg(*[c.alias(f"_{name}") for name, c in of_pages.items()]), "source", "left")
        extra = [F.struct(*[F.coalesce(f"_{name}", F.lit(0)).cast("long").alias(name) for name in of_pages]).alias("left_out")]
    if filtering is not None:
        joined = joined.join(filtering.select("source", F.col("metrics").alias("_filtering")), "source", "left")
        extra.append(F.col("_filtering").alias("filtering"))
    return joined.select(
        "run_id",
        "source",
        F.lit(created_at).alias("timestamp"),
        F.struct(*counts).alias("collection"),
        F.struct(*numbers).alias("statistics"),
        F.struct("started_at", "completed_at").alias("duration"),
        *extra,
    )


def as_json(report: DataFrame) -> DataFrame:
    return report.select(
        "run_id", "source", F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"}).alias("report")
    )


def filter_report(classified: DataFrame) -> DataFrame:
    """The kept ids as rows, so a long list never becomes one value."""
    kept = F.col("change").isNull() | (F.col("change") != "unchanged")
    return classified.filter(kept).select("source", "source_id", "change")


def filter_summary(metrics: DataFrame, run_id: str, created_at: str, error: str | None = None) -> DataFrame:
    """Run, source, time and the worklist metrics of the source, with the error that switched filtering off."""
    numbers = [c for c in metrics.columns if c != "source"]
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        "source",
        F.lit(created_at).alias("timestamp"),
        F.struct(*numbers, F.lit(error).cast("string").alias("error")).alias("metrics"),
    )


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with a header; arrays become text."""
    columns = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in {"array", "struct", "map"} else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)
    return path


def export_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
