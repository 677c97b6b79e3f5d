"""Corpus statistics over the current documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bounds of the length buckets.
SMALL_TEXT = 1_000
LARGE_TEXT = 10_000


def _per_text(total: str) -> Column:
    mean = F.col(total) / F.nullif(F.col("documents_with_text"), F.lit(0))
    return F.round(F.coalesce(mean, F.lit(0.0)), 2)


def corpus_statistics(documents: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts, totals, and averages over the documents that have a text."""
    return (
        documents.groupBy(*(by or []))
        .agg(
            F.count(F.lit(1)).alias("total_documents"),
            F.count_if(F.col("has_text")).alias("documents_with_text"),
            F.coalesce(F.sum(F.col("text_length").cast("long")), F.lit(0)).alias("total_text_length"),
            F.coalesce(F.sum(F.col("word_count").cast("long")), F.lit(0)).alias("total_word_count"),
        )
        .withColumn("documents_without_text", F.col("total_documents") - F.col("documents_with_text"))
        .withColumn("avg_text_length", _per_text("total_text_length"))
        .withColumn("avg_word_count", _per_text("total_word_count"))
    )


def with_share(counts: DataFrame, count: str, by: list[str] | None = None) -> DataFrame:
    """Add ``percent`` of the total per group. Meant for grouped counts: what is
    gathered is one row per bucket, never the documents."""
    total = F.sum(count).over(Window.partitionBy(*(by or [])))
    return counts.withColumn("percent", F.round(F.col(count) / total * 100, 2))


def status_distribution(documents: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Documents per source and status with name and share."""
    names = dictionary.filter("is_current AND dict_type = 'status'").select(
        "source", F.col("entry_id").alias("status_id"), F.col("entry_name").alias("status_name")
    )
    counts = documents.groupBy("source", "status_id").agg(F.count(F.lit(1)).alias("documents"))
    return with_share(counts, "documents", ["source"]).join(names, ["source", "status_id"], "left")


def type_distribution(types: DataFrame) -> DataFrame:
    """Documents per source and type; ``types`` holds one row per document and type."""
    return types.groupBy("source", "type_id").agg(F.count(F.lit(1)).alias("documents"))


def date_range(documents: DataFrame, column: str = "doc_date", by: list[str] | None = None) -> DataFrame:
    return (
        documents.groupBy(*(by or []))
        .agg(F.min(column).alias("oldest"), F.max(column).alias("newest"))
        .withColumn("span_days", F.datediff("newest", "oldest"))
    )


def length_statistics(documents: DataFrame, column: str = "text_length", by: list[str] | None = None) -> DataFrame:
    """Minimum, maximum, mean, exact median and sample standard deviation.

    Rows are first counted per distinct length, so what reaches the last stage
    depends on the number of lengths and not on the number of documents. The
    sums are exact decimals.
    """
    by = by or []
    lengths = (
        documents.filter("has_text")
        .groupBy(*by, F.col(column).cast("long").alias("_length"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    length = F.col("_length").cast("decimal(10,0)")
    n = F.col("_n").cast("decimal(17,0)")
    sums = lengths.groupBy(*by).agg(
        F.sum("_n").alias("documents"),
        F.min("_length").alias("shortest"),
        F.max("_length").alias("longest"),
        F.sum((length * n).cast("decimal(28,0)")).cast("decimal(19,0)").alias("_s1"),
        F.sum((length * length * n).cast("decimal(28,0)")).cast("decimal(28,0)").alias("_s2"),
        F.percentile("_length", F.lit(0.5), F.col("_n")).alias("median"),
    )
    count = F.col("documents")
    # Exact to here: the difference of two large numbers is taken in decimals.
    squares = (F.col("_s2") * count.cast("decimal(10,0)") - F.col("_s1") * F.col("_s1")).cast("double")
    spread = squares / count / F.nullif(count - 1, F.lit(0))
    return sums.select(
        *by,
        "documents",
        "shortest",
        "longest",
        F.round(F.col("_s1").cast("double") / count, 2).alias("mean"),
        "median",
        F.round(F.sqrt(F.greatest(spread, F.lit(0.0))), 2).alias("stddev"),
    )


def length_buckets(documents: DataFrame, column: str = "text_length", by: list[str] | None = None) -> DataFrame:
    bucket = (
        F.when(F.col(column) < SMALL_TEXT, "<1000").when(F.col(column) <= LARGE_TEXT, "1000-10000").otherwise(">10000")
    )
    counts = (
        documents.filter("has_text")
        .groupBy(*(by or []), bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    return with_share(counts, "documents", by)


def count_by(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("metric"), "rows")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def storage_footprint(objects: DataFrame) -> DataFrame:
    """Files and bytes per area, the first part of each object path."""
    area = F.element_at(F.split("path", "/"), 1)
    return objects.groupBy(area.alias("area")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
