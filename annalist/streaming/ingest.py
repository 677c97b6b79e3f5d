"""Incremental ingest of landed lists into the document history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from annalist.operators import history, intake
from annalist.session import work_dir
from annalist.sinks.files import exists
from annalist.sinks.tables import HistoryTable

REJECTS = "source STRING, source_id STRING, source_reg STRING, raw_metadata STRING, reason STRING, stored BOOLEAN"


def numbered(batch: DataFrame, landed: str) -> DataFrame:
    """Rows with ``seq`` counted anew, in order of landing time, then of the given ``seq``.

    Ranges of the order are numbered one after the other, each in its own task,
    so no task sees all rows; rows without a landing time come first.
    """
    ordered = batch.repartitionByRange(F.col(landed).asc_nulls_first(), F.col("seq").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col(landed).asc_nulls_first(), F.col("seq").asc_nulls_first())
    numbered_rows = ordered.withColumn("seq", F.monotonically_increasing_id())
    path = work_dir(batch.sparkSession, "stream-batch")
    numbered_rows.write.parquet(path)
    return batch.sparkSession.read.schema(numbered_rows.schema).parquet(path)


def ingest_documents(
    stream: DataFrame, table: HistoryTable, checkpoint: str, landed: str = "landed_at", rejects: str | None = None
) -> StreamingQuery:
    """Merge newly landed records, then stop.

    ``stream`` carries listed records with text and the landing time. Each batch
    is one commit under the batch's own number, and the stream is the only
    writer of its table: a batch repeated after a failure finds its commit and
    is skipped, so every record counts exactly once. Within a batch, records are ordered by
    landing time, then ``seq``; across batches the order of arrival rules, also
    when a revision date goes backwards.

    Texts follow the rules of a daily run: stripped, and a blank one is none. A
    record without a landing time counts as landed with the batch, before the
    others. What cannot be stored, and what is stored without a text, goes to
    the folder ``rejects`` (:func:`read_rejects`; beside the table if not named).
    """
    folder = rejects or f"{table.path.rstrip('/')}-rejects"

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id + 1 in table.commits():
            return
        rows = numbered(batch, landed)
        now, count = rows.agg(F.max(landed), F.count(F.lit(1))).first()
        if not count:
            return
        # Without any landing time the batch counts as landed when it is merged.
        run_time = F.lit(now).cast("timestamp_ntz") if now else F.current_timestamp().cast("timestamp_ntz")
        canonical = intake.canonicalise(rows, F.to_date(F.coalesce(F.col(landed), run_time)))
        documents = intake.with_stripped_text(intake.accepted(canonical))
        named = ["source", "source_id", "source_reg", "raw_metadata"]
        lost = intake.rejected(canonical).select(*named, F.col("reject_reason").alias("reason"), F.lit(False).alias("stored"))
        textless = documents.filter(F.col("error").isNotNull()).select(*named, F.col("error").alias("reason"), F.lit(True).alias("stored"))
        lost.unionByName(textless).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        stored = intake.history_batch(intake.measure(documents), run_time)
        table.commit(history.merge(table.current_for(stored), stored, history.DOCUMENT, run_time), batch_id + 1)

    return (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Records not stored, and stored ones without a text, of all batches."""
    if not exists(spark, folder):
        return spark.createDataFrame([], f"{REJECTS}, batch INT")
    return spark.read.schema(f"{REJECTS}, batch INT").option("basePath", folder).parquet(folder)
