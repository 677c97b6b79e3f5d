"""Counts per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest_counts(events: DataFrame, time: str, by: list[str], width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows per window and group. On a stream, rows later than ``late`` are dropped.

    Watermarks want times with a zone; times without one are read in the
    session zone and given back without it.
    """
    kind = events.schema[time].dataType.typeName()
    return (
        events.select(F.col(time).cast("timestamp").alias("_time"), *by)
        .withWatermark("_time", late)
        .groupBy(F.window("_time", width).alias("_window"), *by)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.col("_window.start").cast(kind).alias("window_start"),
            F.col("_window.end").cast(kind).alias("window_end"),
            *by,
            "rows",
        )
    )


def append_available(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the windows that are final by now, then stop."""
    return (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
