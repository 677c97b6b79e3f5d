"""Streams that run until what has landed is consumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist import schemas
from annalist.session import work_dir
from annalist.sinks.tables import HistoryTable
from annalist.streaming import ingest, windows
from checks import feed
from checks.feed import TIME_1, TIME_2, with_feed
from checks.history_queries import DOCUMENT_COLUMNS
from checks.registry import Tables, query


@query("stream_ingest", with_feed(f"SELECT {', '.join(DOCUMENT_COLUMNS)} FROM hist2"))
def stream_ingest(t: Tables) -> DataFrame:
    """List 1 lands and is taken in, then list 2; both through one checkpoint."""
    landing, checkpoint = work_dir(t.spark, "landing"), work_dir(t.spark, "stream")
    table = HistoryTable(t.spark, work_dir(t.spark, "documents"), schemas.DOCUMENTS)
    for number, time in ((1, TIME_1), (2, TIME_2)):
        landed = feed.listing(t, number).withColumn("landed_at", F.lit(time).cast("timestamp_ntz"))
        landed.write.mode("append").parquet(landing)
        stream = t.spark.readStream.schema(landed.schema).parquet(landing)
        ingest.ingest_documents(stream, table, checkpoint).awaitTermination()
    return table.read().select(*DOCUMENT_COLUMNS)


_REJECTS = " UNION ALL ".join(
    f"""SELECT source, source_id, coalesce(reject_reason, 'No text') AS reason, reject_reason IS NULL AS stored
    FROM canon{n} WHERE reject_reason IS NOT NULL OR text IS NULL"""
    for n in (1, 2)
)


@query("stream_rejects", with_feed(f"SELECT * FROM ({_REJECTS}) AS r"))
def stream_rejects(t: Tables) -> DataFrame:
    """What both lists could not store, or store without a text."""
    landing, checkpoint = work_dir(t.spark, "landing"), work_dir(t.spark, "stream")
    table = HistoryTable(t.spark, work_dir(t.spark, "documents"), schemas.DOCUMENTS)
    rejects = work_dir(t.spark, "rejects")
    for number, time in ((1, TIME_1), (2, TIME_2)):
        # Every seventh text is padded, which changes nothing; every ninth record has no landing time.
        padded = F.when(F.col("dokid") % 7 == 0, F.concat(F.lit(" \n"), "text", F.lit("\t"))).otherwise(F.col("text"))
        at = F.when(F.col("dokid") % 9 != 0, F.lit(time)).cast("timestamp_ntz")
        landed = feed.listing(t, number).withColumn("text", padded).withColumn("landed_at", at)
        landed.write.mode("append").parquet(landing)
        stream = t.spark.readStream.schema(landed.schema).parquet(landing)
        ingest.ingest_documents(stream, table, checkpoint, rejects=rejects).awaitTermination()
    return ingest.read_rejects(t.spark, rejects).select("source", "source_id", "reason", "stored")


_WINDOWS = """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
  event_type, count(*) AS rows FROM events GROUP BY ALL
"""


@query("windowed_ingest_counts", _WINDOWS)
def windowed_ingest_counts(t: Tables) -> DataFrame:
    return windows.ingest_counts(t.events, "ts", ["event_type"])


@query(
    "streamed_ingest_counts",
    f"SELECT * FROM ({_WINDOWS}) AS w WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)",
)
def streamed_ingest_counts(t: Tables) -> DataFrame:
    """The same counts as a stream: windows still open at the watermark are not out yet."""
    path, checkpoint = work_dir(t.spark, "windows"), work_dir(t.spark, "stream")
    events = (
        t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    )
    counts = windows.ingest_counts(events, "ts", ["event_type"])
    windows.append_available(counts, path, checkpoint).awaitTermination()
    return t.spark.read.schema(counts.schema).parquet(path)
