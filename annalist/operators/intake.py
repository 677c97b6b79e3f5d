"""From listed records to canonical documents, worklist and stored texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import text as T
from annalist.functions import values as V
from annalist.functions.paths import document_paths
from annalist.schemas import LIST_RECORD_FIELDS


def canonicalise(listing: DataFrame, collected_on: str | Column) -> DataFrame:
    """Listed records to canonical documents.

    ``reject_reason`` says why a record cannot be stored: a field that cannot be
    read, no id, a day that does not exist, or a type that is no number.
    ``raw_metadata`` is the record as it came, where the listing has its text. ``listed_date`` is the date the list
    gives, ``revision_date`` falls back to the document date, then to the day
    of collection.
    """
    day = F.lit(collected_on).cast("date") if isinstance(collected_on, str) else collected_on
    poddat, orgdat = F.col("poddat"), F.col("orgdat")
    org_ids = V.parse_ids(V.first_truthy(F.col("orgid"), F.col("org")))
    unread = F.col("record_error") if "record_error" in listing.columns else F.lit(None).cast("string")
    reject = (
        F.when(unread.isNotNull(), unread)
        .when(F.col("dokid").isNull(), "missing id")
        .when(V.is_impossible_day(poddat) | V.is_impossible_day(orgdat), "impossible date")
        .when(V.has_bad_id(F.col("types")), "bad type id")
    )
    raw = V.to_json_text(*[F.col(c) for c in LIST_RECORD_FIELDS if c in listing.columns])
    if "record" in listing.columns:
        raw = F.coalesce(F.col("record"), raw)
    carried = [c for c in listing.columns if c not in {*LIST_RECORD_FIELDS, "source", "record", "record_error"}]
    return listing.select(
        "source",
        F.col("dokid").cast("string").alias("source_id"),
        F.col("nreg").alias("source_reg"),
        F.coalesce("nazva", F.lit("")).alias("title"),
        F.col("status").cast("int").alias("status_id"),
        V.parse_ids(F.col("types")).alias("type_ids"),
        F.get(org_ids, F.lit(0)).alias("org_id"),
        org_ids.alias("org_ids"),
        V.parse_day(orgdat).alias("doc_date"),
        V.parse_day(F.coalesce(V.day_number(poddat), orgdat)).alias("listed_date"),
        V.parse_day(poddat).alias("listed_revision"),
        F.coalesce(V.parse_day(poddat), V.parse_day(orgdat), day).alias("revision_date"),
        day.alias("collection_date"),
        raw.alias("raw_metadata"),
        reject.alias("reject_reason"),
        *carried,
    )


def accepted(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col("reject_reason").isNotNull())


def first_documents(listing: DataFrame, count: int | str, order: str = "seq") -> DataFrame:
    """The first ``count`` records in list order; 0 means all."""
    count = int(count)
    return listing.orderBy(order).limit(count) if count > 0 else listing


def prefer_list_title(cards: DataFrame, listing: DataFrame) -> DataFrame:
    """Titles from the list where it has one, since card titles may be damaged.

    ``listing`` holds a document once.
    """
    titles = listing.select("source", "source_id", F.col("title").alias("_listed"))
    return (
        cards.join(titles, ["source", "source_id"], "left")
        .withColumn("title", F.coalesce("_listed", "title"))
        .drop("_listed")
    )


def classify(documents: DataFrame, current: DataFrame | None, skip_existing: bool = True) -> DataFrame:
    """Add ``change``: new, changed or unchanged against the stored documents.

    ``current`` is the narrow current state, unique per (source, source_id).
    Without it, or with ``skip_existing`` off, everything is to be fetched.
    """
    if current is None or not skip_existing:
        return documents.withColumn("change", F.lit(None).cast("string"))
    stored = current.select(
        "source", "source_id", F.col("revision_date").alias("_stored_date"), F.lit(True).alias("_stored")
    )
    same = F.col("listed_date") == F.col("_stored_date")
    change = (
        F.when(F.col("_stored").isNull(), "new").when(F.coalesce(same, F.lit(False)), "unchanged").otherwise("changed")
    )
    return (
        documents.join(stored, ["source", "source_id"], "left")
        .withColumn("change", change)
        .drop("_stored", "_stored_date")
    )


def worklist(classified: DataFrame) -> DataFrame:
    """What has to be fetched."""
    return classified.filter(F.col("change").isNull() | (F.col("change") != "unchanged"))


def listed_only(classified: DataFrame, current: DataFrame, tracked: list[str]) -> DataFrame:
    """Listed documents that are not to be fetched, with the measures stored for them.

    ``moved`` says that a tracked column, such as the title, differs from the
    stored version although the date is the same: the text is to be rendered anew.
    """
    stored = current.select("source", "source_id", F.col("content_hash").alias("_hash"), "has_text", "text_length", "word_count")
    moved = V.content_hash(*[F.col(c) for c in tracked]) != F.col("_hash")
    rows = classified.filter(F.col("change") == "unchanged").join(stored, ["source", "source_id"])
    return rows.withColumn("moved", moved).drop("_hash")


def worklist_metrics(classified: DataFrame, by: list[str] | None = None) -> DataFrame:
    return classified.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("change") == "new").alias("new"),
        F.count_if(F.col("change") == "changed").alias("changed"),
        F.count_if(F.col("change") == "unchanged").alias("unchanged"),
        F.count_if(F.col("change") == "unchanged").alias("skipped"),
        F.coalesce(F.bool_or(F.col("change").isNotNull()), F.lit(False)).alias("filter_enabled"),
    )


def saved_share(metrics: DataFrame) -> DataFrame:
    """Add ``saved_percent``, the share of listed documents not fetched again."""
    share = F.col("skipped") / F.nullif(F.col("total"), F.lit(0)) * 100
    return metrics.withColumn("saved_percent", F.round(F.coalesce(share, F.lit(0.0)), 2))


def not_stored(documents: DataFrame, current: DataFrame) -> DataFrame:
    return documents.join(current.select("source", "source_id"), ["source", "source_id"], "left_anti")


def with_stripped_text(documents: DataFrame) -> DataFrame:
    """``text`` without outer blanks, null where none is left, and ``error`` "No text" there."""
    return documents.withColumn("text", F.nullif(T.strip_text(F.col("text")), F.lit(""))).withColumn(
        "error", F.when(F.col("text").isNull(), "No text")
    )


def attach_texts(documents: DataFrame, texts: DataFrame) -> DataFrame:
    """Left join the landed texts, stripped; ``error`` is "No text" where none is left."""
    return with_stripped_text(documents.join(texts.select("source", "source_id", "text"), ["source", "source_id"], "left"))


def fetch_metrics(fetched: DataFrame, by: list[str] | None = None) -> DataFrame:
    return fetched.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("error").isNull()).alias("success"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def failures(fetched: DataFrame, reason: str = "error") -> DataFrame:
    return fetched.filter(F.col(reason).isNotNull()).select(
        "source", "source_id", "source_reg", F.col(reason).alias("error"), *[c for c in ("seq",) if c in fetched.columns]
    )


def first_failures(failed: DataFrame, count: int = 10) -> DataFrame:
    return failed.orderBy("source", "seq").limit(count)


def measure(documents: DataFrame) -> DataFrame:
    """Add the measures of the raw text."""
    text = F.col("text")
    return documents.select(
        "*",
        text.isNotNull().alias("has_text"),
        T.text_length(text).alias("text_length"),
        T.word_count(text).alias("word_count"),
    )


def render(documents: DataFrame, escape: bool = True) -> DataFrame:
    """Add ``markdown``, the measures of the raw text and ``outcome``.

    Measures are taken in the same pass as cleaning, so texts are read once.
    """
    head = T.header(
        F.col("source"),
        F.col("source_id"),
        F.col("source_reg"),
        F.col("title"),
        F.col("doc_date"),
        F.col("listed_revision"),
        F.col("status_id"),
        F.col("type_ids"),
        F.nullif(F.array_join(F.col("org_ids").cast("array<string>"), "|"), F.lit("")),
        escape,
    )
    blank = T.is_blank(F.col("text"))
    return (
        measure(documents)
        .withColumn("markdown", F.when(~blank, T.markdown(head, F.col("text"))))
        .withColumn("outcome", F.when(blank, "skipped").when(F.col("markdown").isNull(), "failed").otherwise("success"))
    )


def render_metrics(rendered: DataFrame, by: list[str] | None = None) -> DataFrame:
    return rendered.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("outcome") == "success").alias("success"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
    )


def history_batch(measured: DataFrame, run_time: str | Column) -> DataFrame:
    """The columns the document history keeps, with the four stored paths."""
    paths = document_paths(F.col("source"), F.col("source_id"), F.col("revision_date"), F.col("collection_date"))
    stored = ["raw_path_revision", "raw_path_collection", "processed_path_revision", "processed_path_collection"]
    return measured.select(
        "source",
        "source_id",
        "source_reg",
        "title",
        "status_id",
        "org_id",
        "doc_date",
        "revision_date",
        *[paths[name].alias(name) for name in stored],
        "type_ids",
        "has_text",
        "text_length",
        "word_count",
        F.lit(run_time).cast("timestamp_ntz").alias("collected_at"),
        F.lit(None).cast("timestamp_ntz").alias("transformed_at"),
        "seq",
    )
