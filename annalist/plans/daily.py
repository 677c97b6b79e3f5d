"""One collection run over a landing zone, as a sequence of DataFrame jobs.

Results that several later steps need are written once and read back, so no
step is computed twice and a lost executor costs only its own tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist import schemas
from annalist.operators import doctypes, history, intake, ledger, quality, retention, snapshots, stats
from annalist.sinks import artefacts, layout
from annalist.sinks.files import child_names, exists
from annalist.sinks.tables import HistoryTable
from annalist.sources.landing import list_objects
from annalist.sources.registry import SourceReader

# Characters of an error that a report keeps.
ERROR_CHARS = 500

HISTORIES = {
    "dictionaries": schemas.DICTIONARIES,
    "documents": schemas.DOCUMENTS,
    "document_types": schemas.DOCUMENT_TYPES,
}


class Store:
    """All tables and areas of one installation, below one root.

    Each source has its own history tables, so a run rewrites the rows in force
    of its own source only.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.raw = f"{self.root}/raw"
        self.processed = f"{self.root}/processed"
        self.dictionary_area = f"{self.root}/dictionaries"
        self.temp = f"{self.root}/temp"

    def table(self, name: str, source: str) -> HistoryTable:
        return HistoryTable(self.spark, f"{self.root}/tables/{name}/source={source}", HISTORIES[name])

    def read(self, name: str) -> DataFrame:
        """All versions of all sources."""
        folders = child_names(self.spark, f"{self.root}/tables/{name}")
        tables = [self.table(name, folder.removeprefix("source=")).read() for folder in folders]
        return reduce(DataFrame.unionByName, tables, self.spark.createDataFrame([], HISTORIES[name]))

    def _keyed(self, name: str, schema: str) -> DataFrame:
        """Small keyed tables are kept as one folder per run or day."""
        path = f"{self.root}/tables/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).drop("part")

    def runs(self) -> DataFrame:
        return self._keyed("collection_runs", schemas.RUNS)

    def snapshot_register(self) -> DataFrame:
        return self._keyed("dictionary_snapshots", schemas.SNAPSHOTS)

    def replace(self, name: str, rows: DataFrame, part: str) -> None:
        """Keyed replace: the folder named ``part`` holds one run's or day's rows."""
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/tables/{name}/{part}")

    def stage(self, df: DataFrame, run_id: str, step: str) -> DataFrame:
        path = f"{self.root}/staging/run_id={run_id}/{step}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class RunResult:
    """What a run reports; all small, one row per source or check."""

    worklist: DataFrame
    fetch: DataFrame
    transform: DataFrame
    actions: DataFrame
    quality: DataFrame
    report: DataFrame
    first_failures: DataFrame


def collect_dictionaries(reader: SourceReader, store: Store, run_id: str, run_time: str, day: str) -> DataFrame:
    """Merge the landed dictionaries and snapshot the result; returns action counts."""
    batch = store.stage(reader.dictionaries(store.spark), run_id, "dictionaries")
    table = store.table("dictionaries", reader.name)
    stored = table.current()
    actions = store.stage(history.merge_actions(stored, batch, history.DICTIONARY), run_id, "dictionary_actions")
    table.commit(history.merge(stored, batch, history.DICTIONARY, run_time))
    snapshot = snapshots.snapshot_rows(table.current(), day)
    artefacts.write_snapshot(snapshot, store.dictionary_area)
    store.replace("dictionary_snapshots", snapshots.register_rows(snapshot), f"part={reader.name}-{day}")
    return history.action_counts(actions, ["source", "dict_type"])


def classify_or_take_all(
    store: Store, documents: DataFrame, table: HistoryTable, skip_existing: bool, run_id: str
) -> tuple[DataFrame, str | None]:
    """The documents with their ``change``, staged, and what went wrong.

    If the history cannot be read, be it a manifest when the plan is built or a file
    when it runs, the whole list is taken, and the error is returned to be reported.
    """
    if skip_existing:
        try:
            stored = history.current_state(table.current())
            return store.stage(intake.classify(documents, stored), run_id, "classified"), None
        except (PySparkException, Py4JError) as error:
            return store.stage(intake.classify(documents, None), run_id, "classified"), f"{type(error).__name__}: {error}"[:ERROR_CHARS]
    return store.stage(intake.classify(documents, None), run_id, "classified"), None


def run_day(
    reader: SourceReader,
    store: Store,
    run_id: str,
    started_at: str,
    completed_at: str,
    skip_existing: bool = True,
    max_documents: int = 0,
    min_text_length: int = quality.MIN_TEXT_LENGTH,
) -> RunResult:
    """Dictionaries, list, worklist, texts, cleaning, history, checks, report.

    Texts are read, rendered and written for the worklist, and for listed documents
    whose title or status moved while their date did not: these are taken from the
    raw area, by their partitions. All other documents are merged by the measures
    stored for them, so the texts a day handles follow its change.

    A history that cannot be read switches filtering off: the whole list is fetched and
    the error stands in the filter report, the metrics and the report. Texts are saved
    before the merge, which needs the history and fails if it still cannot be read;
    its commits stay as they were.

    All times are given, none is taken from the clock, so a rerun is equal.
    """
    spark, day = store.spark, started_at[:10]
    columns = [f.split()[0] for f in schemas.RUNS.split(", ")]
    # The run is in the ledger before it does anything; one that finished before keeps its row until it has again.
    own = store.runs().filter((F.col("run_id") == f"{run_id}_{reader.name}") & (F.col("status") != "running"))
    finished = store.stage(own, run_id, "finished_before")
    if finished.isEmpty():
        store.replace("collection_runs", ledger.running_rows(spark, [reader.name], run_id, started_at).select(*columns), f"part={run_id}-{reader.name}")
    document_table = store.table("documents", reader.name)
    type_table = store.table("document_types", reader.name)
    collect_dictionaries(reader, store, run_id, started_at, day)

    # List, limit, worklist. Copies of a record count once per occurrence.
    listing = intake.first_documents(reader.listing(spark), max_documents)
    canonical = store.stage(intake.canonicalise(listing, day), run_id, "canonical")
    listed = canonical.select("source", "source_id", "raw_metadata", "reject_reason", "seq")
    artefacts.write_artefact(listed, store.temp, day, run_id, "document_list")
    left_out = store.stage(reader.pages_left_out(spark), run_id, "pages_left_out")
    artefacts.write_artefact(left_out, store.temp, day, run_id, "pages_left_out")
    documents = intake.accepted(canonical)
    classified, error = classify_or_take_all(store, documents, document_table, skip_existing, run_id)
    artefacts.write_artefact(artefacts.filter_report(classified), store.temp, day, run_id, "filter_documents")
    metrics = intake.saved_share(intake.worklist_metrics(classified, ["source"]))
    filtering = artefacts.filter_summary(metrics, run_id, started_at, error)
    artefacts.write_artefact(filtering, store.temp, day, run_id, "filter_report")

    # Texts of the worklist go to the raw area, failures to the artefacts.
    fetched = store.stage(intake.attach_texts(intake.worklist(classified), reader.texts(spark)), run_id, "fetched")
    layout.save_raw(fetched, store.raw)
    failed = intake.failures(fetched)
    artefacts.write_artefact(failed, store.temp, day, run_id, "failed_documents")

    # Documents whose text is known from an earlier day: only what moved is rendered again.
    live = document_table.current() if error is None else spark.createDataFrame([], schemas.DOCUMENTS)
    rest = store.stage(intake.listed_only(classified, live, history.DOCUMENT.tracked), run_id, "listed_only")
    again = rest.filter(F.col("moved") & F.col("has_text"))
    columns_of = classified.columns
    raw_path = f"{store.raw}/by_revision"
    like = layout.by_revision(fetched.select(*layout.RAW_COLUMNS))
    area = layout.read_area(like, raw_path, layout.REVISION_PARTS).filter(F.col("source") == reader.name)
    # A text that was not fetched may be there from an earlier run of the same revision.
    wanted = fetched.filter(F.col("text").isNull()).select(*columns_of).unionByName(again.select(*columns_of))
    at = ["source", "source_id", "year", "month", "day"]
    stored_texts = layout.by_revision(wanted).join(area.select(*at, "text"), at, "left").select(*columns_of, "text")

    # Cleaning and measures in one pass over the texts.
    known = fetched.filter(F.col("text").isNotNull()).select(*columns_of, "text").unionByName(stored_texts)
    rendered = store.stage(intake.render(known), run_id, "rendered")
    layout.save_processed(rendered, store.processed)
    kept = rest.filter(~(F.col("moved") & F.col("has_text"))).withColumn("outcome", F.when(F.col("has_text"), "success").otherwise("skipped"))
    narrow = [c for c in rendered.columns if c not in ("text", "markdown")]
    measured = rendered.select(*narrow).unionByName(kept.select(*narrow))

    # History of documents and types.
    batch = intake.history_batch(measured, started_at)
    before = document_table.current_for(batch)
    actions = store.stage(history.merge_actions(before, batch, history.DOCUMENT), run_id, "actions")
    merged = store.stage(history.merge(before, batch, history.DOCUMENT, started_at), run_id, "merged")
    document_table.commit(merged)
    types = doctypes.listed_types(merged)
    type_table.commit(doctypes.merge_types(type_table.current_for(types), types, started_at))

    # Ledger, checks and report read the committed tables.
    live = document_table.current()
    run = ledger.run_rows(canonical, actions, intake.rejected(canonical), live, run_id, started_at, completed_at, [reader.name], finished)
    store.replace("collection_runs", run.select(*columns), f"part={run_id}-{reader.name}")
    statuses = quality.valid_statuses(store.table("dictionaries", reader.name).current())
    checked = quality.flag_documents(live, statuses, min_text_length)
    scores = quality.quality_score(quality.check_counts(checked, ["source"]))
    statistics = stats.corpus_statistics(live, ["source"])
    report = artefacts.collection_report(run, statistics, completed_at, left_out, filtering)
    artefacts.write_artefact(report, store.temp, day, run_id, "report")

    return RunResult(
        worklist=metrics.withColumn("error", F.lit(error).cast("string")),
        fetch=intake.fetch_metrics(fetched, ["source"]),
        transform=intake.render_metrics(measured, ["source"]),
        actions=history.action_counts(actions, ["source"]),
        quality=scores,
        report=report,
        first_failures=intake.first_failures(failed),
    )


def clean_temp(store: Store, as_of: str, days: int = retention.RETENTION_DAYS, dry_run: bool = True) -> int:
    return retention.delete_expired(store.temp, list_objects(store.spark, store.temp), as_of, days, dry_run)
