"""History of the types attached to each document version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.operators.history import at


def listed_types(merged: DataFrame) -> DataFrame:
    """Version ids with the non-empty type list the last batch gave them."""
    return merged.select("version_id", "type_ids").filter(F.size("type_ids") > 0)


def _compared(current: DataFrame, listed: DataFrame) -> DataFrame:
    """One row per (version, type) in force or listed: ``_stored``, ``_wanted`` and ``_listed``, whether the version is listed.

    Rows in force and listed types are stacked and shuffled once, by version;
    marking a version's rows and bringing equal types together both use that order.
    """
    stored = current.filter("is_current").select(
        "version_id", "type_id", "valid_from", "created_at", F.lit(True).alias("_stored"), F.lit(False).alias("_wanted")
    )
    wanted = listed.select(
        "version_id", F.explode(F.array_distinct("type_ids")).alias("type_id"), F.lit(False).alias("_stored"), F.lit(True).alias("_wanted")
    )
    stacked = stored.unionByName(wanted, allowMissingColumns=True)
    return (
        stacked.withColumn("_listed", F.max("_wanted").over(Window.partitionBy("version_id")))
        .groupBy("version_id", "type_id")
        .agg(*[F.max(c).alias(c) for c in ("valid_from", "created_at", "_stored", "_wanted", "_listed")])
    )


def type_delta(current: DataFrame, listed: DataFrame) -> DataFrame:
    """Types to open and types to close, one row each (``change`` = open or close).

    Only versions in ``listed`` are compared; others keep their types.
    """
    change = F.when(~F.col("_stored"), "open").when(F.col("_listed") & ~F.col("_wanted"), "close")
    return _compared(current, listed).select("version_id", "type_id", change.alias("change")).filter(F.col("change").isNotNull())


def merge_types(current: DataFrame, listed: DataFrame, run_time: str | Column) -> DataFrame:
    """Types in force before or after the batch.

    A listed version gets exactly its listed types; a version that is not
    listed, or whose list is empty, is left alone - also when the document has
    moved on to a newer version. :func:`current_types` hides those.
    """
    now = at(run_time)
    dropped = F.col("_listed") & ~F.col("_wanted")
    return _compared(current, listed).select(
        "version_id",
        "type_id",
        F.coalesce("valid_from", now).alias("valid_from"),
        F.when(dropped, now).alias("valid_to"),
        (~dropped).alias("is_current"),
        F.coalesce("created_at", now).alias("created_at"),
    )


def current_types(types: DataFrame, documents: DataFrame) -> DataFrame:
    """Open types of the document versions in force."""
    live = documents.filter("is_current").select("version_id", "source", "source_id")
    return types.filter("is_current").join(live, "version_id")


def name_types(types: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``type_name``; null where the dictionary has no entry."""
    names = dictionary.filter("is_current AND dict_type = 'type'").select(
        "source", F.col("entry_id").alias("type_id"), F.col("entry_name").alias("type_name")
    )
    return types.join(names, ["source", "type_id"], "left")
