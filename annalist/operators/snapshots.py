"""Dictionary snapshots and their register."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.operators.ledger import upsert


def snapshot_rows(dictionary: DataFrame, day: str) -> DataFrame:
    """Current entries, ready to be written by source, date and dictionary type."""
    return dictionary.filter("is_current").select(
        "source",
        F.lit(day).cast("date").alias("date"),
        "dict_type",
        "entry_id",
        "entry_name",
        F.date_format("valid_from", "yyyy-MM-dd'T'HH:mm:ss").alias("valid_from"),
    )


def register_rows(snapshot: DataFrame) -> DataFrame:
    return (
        snapshot.groupBy("source", "date", "dict_type")
        .agg(F.count(F.lit(1)).alias("_entries"))
        .groupBy("source", "date")
        .agg(F.sort_array(F.collect_set("dict_type")).alias("dict_types"), F.sum("_entries").alias("_entries"))
        .select(
            "source",
            F.col("date").alias("snapshot_date"),
            F.concat(F.lit("snapshots/source="), "source", F.lit("/date="), F.col("date").cast("string"), F.lit("/")).alias(
                "snapshot_path"
            ),
            "dict_types",
            F.col("_entries").cast("int").alias("entry_count"),
        )
    )


def register(stored: DataFrame, snapshot: DataFrame) -> DataFrame:
    return upsert(stored, register_rows(snapshot), ["source", "snapshot_date"])


def entries_per_type(dictionary: DataFrame) -> DataFrame:
    return dictionary.filter("is_current").groupBy("source", "dict_type").agg(F.count(F.lit(1)).alias("entries"))
