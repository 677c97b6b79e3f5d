"""Object paths of the two partition layouts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffix of each kind of object.
TEXT_SUFFIX = ".txt"
META_SUFFIX = ".meta.json"
PROCESSED_SUFFIX = ".md"


def revision_prefix(source: Column, revision_date: Column) -> Column:
    return F.concat(
        F.lit("by_revision/source="),
        source,
        F.lit("/year="),
        F.year(revision_date).cast("string"),
        F.lit("/month="),
        F.date_format(revision_date, "MM"),
        F.lit("/day="),
        F.date_format(revision_date, "dd"),
        F.lit("/"),
    )


def collection_prefix(source: Column, collection_date: Column) -> Column:
    return F.concat(
        F.lit("by_collection/date="), collection_date.cast("string"), F.lit("/source="), source, F.lit("/")
    )


def document_paths(
    source: Column, source_id: Column, revision_date: Column, collection_date: Column
) -> dict[str, Column]:
    """The six object paths of one document, by name."""
    revision = revision_prefix(source, revision_date)
    collection = collection_prefix(source, collection_date)
    return {
        "raw_path_revision": F.concat(revision, source_id, F.lit(TEXT_SUFFIX)),
        "raw_path_collection": F.concat(collection, source_id, F.lit(TEXT_SUFFIX)),
        "meta_path_revision": F.concat(revision, source_id, F.lit(META_SUFFIX)),
        "meta_path_collection": F.concat(collection, source_id, F.lit(META_SUFFIX)),
        "processed_path_revision": F.concat(revision, source_id, F.lit(PROCESSED_SUFFIX)),
        "processed_path_collection": F.concat(collection, source_id, F.lit(PROCESSED_SUFFIX)),
    }


def temp_path(day: Column, run_id: Column, task: Column, filename: Column) -> Column:
    return F.concat(
        F.lit("date="), day.cast("string"), F.lit("/run_id="), run_id, F.lit("/task_"), task, F.lit("/"), filename
    )
