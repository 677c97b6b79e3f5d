"""Readers of landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annalist.functions.text import decode_cp1251, strip_text
from annalist.functions.values import parse_iso_day
from annalist.schemas import LIST_PAGE, LIST_RECORD_FIELDS, LIST_RECORD_KINDS, LIST_RECORD_TEXT, MANIFEST
from annalist.session import work_dir

# Fields that hold a day as a number such as 20260130.
DAY_FIELDS = ("orgdat", "poddat", "pridat")
# Numbers a record cannot be stored without being right.
CHECKED_NUMBERS = ("dokid", "status")
# Pages that do not count; records is null where a page cannot be read.
LEFT_OUT = "source string, page int, records int, reason string"


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


# --- dictionaries -----------------------------------------------------------


def read_dictionary_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of landed dictionary files: file, line_no, line. Encoded in windows-1251.

    Files are read as lines of bytes, which Spark cuts into blocks at line ends, so
    a large file is the work of many tasks. ``line_no`` grows with the place in the
    file but leaves numbers out: it counts from the start of the line's block. A
    file that cannot be read gives the lines before its fault, mostly none, and stops
    no other.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        decode_cp1251(F.col("value").cast("binary")).alias("line"),
    )
    # A line has a byte at least, so numbers of a block end before the next one's begin.
    first = F.min("_row").over(Window.partitionBy("file", "_block"))
    return lines.select("file", (F.col("_block") + F.col("_row") - first).alias("line_no"), "line")


def dictionary_lines(lines: DataFrame) -> DataFrame:
    """Tab-separated lines to entries. Lines without two fields or without a
    whole number in front are dropped, further fields are ignored."""
    fields = F.split("line", "\t")
    return (
        lines.filter(F.size(fields) >= 2)
        .withColumn("entry_id", strip_text(fields[0]).try_cast("int"))
        .withColumn("entry_name", strip_text(fields[1]))
        .filter(F.col("entry_id").isNotNull())
        .drop("line")
    )


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary manifests: dict_type (file name) and the link of the data file.

    ``link`` is null where the manifest lists no item.
    """
    rows = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    return rows.select(
        file_stem(F.col("_metadata.file_path")).alias("dict_type"), F.get("item", F.lit(0))["link"].alias("link")
    )


def dictionary_entries(manifest: DataFrame, lines: DataFrame) -> DataFrame:
    """Entries of every dictionary whose file has landed; the others are skipped."""
    linked = manifest.withColumn("_name", file_name(F.col("link")))
    entries = dictionary_lines(lines.withColumn("_name", file_name(F.col("file")))).join(linked, "_name")
    return entries.select("dict_type", "entry_id", "entry_name", F.col("line_no").cast("long").alias("seq"))


def missing_dictionaries(manifest: DataFrame, lines: DataFrame) -> DataFrame:
    """Manifests without a link, without a landed file or whose file gives no line, as it is empty or cannot be read."""
    landed = lines.select(file_name(F.col("file")).alias("_name")).distinct()
    return manifest.withColumn("_name", file_name(F.col("link"))).join(landed, "_name", "left_anti").drop("_name")


# --- document lists ---------------------------------------------------------


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """List pages, one row each: file, page, announced, list, broken.

    The number comes from ``page{N}.json``. ``list`` holds the records as the
    JSON text they came in; only a file that is no JSON, or whose list is none,
    is broken.
    """
    rows = (
        spark.read.schema(LIST_PAGE)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("recursiveFileLookup", True)
        .json(path)
    )
    number = F.regexp_extract("_metadata.file_path", r".*page=?([0-9]+)[./][^/]*$", 1).try_cast("int")
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        number.alias("page"),
        F.col("max").try_cast("int").alias("announced"),
        "list",
        F.col("_corrupt_record").isNotNull().alias("broken"),
    )


def _counted_pages(pages: DataFrame, max_pages: int | None) -> DataFrame:
    """Pages that count, with the number of records ``before`` each in its source."""
    if max_pages is not None:
        pages = pages.filter(F.col("page") <= max_pages)
    ordered = Window.partitionBy("source").orderBy("page")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    records = F.coalesce("records", F.lit(0)).cast("long")
    bad = F.col("broken") | (records == 0) | (F.row_number().over(ordered) != F.col("page"))
    full = F.sum(records).over(so_far) >= F.col("announced")
    return (
        pages.withColumn("before", F.coalesce(F.sum(records).over(before), F.lit(0)))
        .withColumn("_bad", bad)
        .withColumn("_ends", F.col("_bad") | F.coalesce(full, F.lit(False)))
        .withColumn("_ended", F.coalesce(F.max("_ends").over(before), F.lit(False)))
        .filter(~F.col("_ended") & ~F.col("_bad"))
        .select("source", "page", "before")
    )


def page_sizes(pages: DataFrame) -> DataFrame:
    """Pages with the number of their records instead of these; null where there is no list."""
    records = F.when(F.col("list").isNotNull(), F.size("list"))
    return pages.select("source", "page", records.alias("records"), "announced", "broken")


def complete_pages(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Numbers of the pages that count: source, page.

    ``pages`` has source, page, records (their number), announced and broken. A
    listing ends before the first page that is empty, broken or missing, and
    after the page at which the records so far reach its own announced total.
    Without ``max_pages`` no page is left out for its number. Rows here are
    pages, not records, so the ordered pass is over few rows.
    """
    return _counted_pages(pages, max_pages).select("source", "page")


def pages_left_out(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Pages that do not count and why: source, page, records, reason."""
    kept = complete_pages(pages, max_pages)
    over = F.lit(False) if max_pages is None else F.col("page") > max_pages
    reason = F.when(over, "over the page limit").when(F.col("broken"), "unreadable").otherwise("after the end")
    return pages.join(kept, ["source", "page"], "left_anti").select("source", "page", "records", reason.alias("reason"))


def _day_number(text: Column) -> Column:
    """A day as a number, from digits or from an ISO date; other text gives null."""
    day = parse_iso_day(text)
    return F.coalesce(text.try_cast("bigint"), F.date_format(day, "yyyyMMdd").cast("bigint"))


def typed_records(records: DataFrame) -> DataFrame:
    """Parse ``record``, JSON text, field by field; the text itself stays as it came.

    A number may come as text and a day as an ISO date. ``record_error`` says
    what cannot be read: the whole record, its id or its status. Other odd
    fields are null, as unreadable days are.
    """
    parsed = records.withColumn("_fields", F.from_json("record", LIST_RECORD_TEXT))
    fields = []
    for name in LIST_RECORD_FIELDS:
        value = F.col(f"_fields.{name}")
        kind = LIST_RECORD_KINDS[name]
        typed = _day_number(value) if name in DAY_FIELDS else value.try_cast(kind)
        fields.append(typed.alias(name))
    error = F.when(~F.coalesce(F.ltrim("record").startswith("{"), F.lit(False)) | F.col("_fields").isNull(), "unreadable record")
    for name in CHECKED_NUMBERS:
        value = F.col(f"_fields.{name}")
        error = error.when(value.isNotNull() & value.try_cast(LIST_RECORD_KINDS[name]).isNull(), f"bad number in {name}")
    kept = [c for c in records.columns if c != "record"]
    return parsed.select(*kept, *fields, "record", error.alias("record_error"))


def listed_records(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Records of the complete pages: source, fields, record, record_error, seq.

    ``seq`` counts the records of a source in list order, from 0. The pages are
    staged, as opening a file costs more than its records: none is opened for its
    size and once more for its list. Their rows are gathered first, for a task of
    the reader has few files and would write one of its own.
    """
    path = work_dir(pages.sparkSession, "list-pages")
    columns = pages.select("source", "page", "announced", "list", "broken")
    columns.hint("rebalance").write.option("compression", "zstd").parquet(path)
    pages = pages.sparkSession.read.schema(columns.schema).parquet(path)
    kept = pages.join(_counted_pages(page_sizes(pages), max_pages), ["source", "page"])
    records = kept.select("source", "before", F.posexplode("list").alias("_at", "record"))
    return typed_records(records.select("source", "record", (F.col("before") + F.col("_at")).alias("seq")))


# --- texts and stored objects ----------------------------------------------


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One landed file per document; the id is the file name."""
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return rows.select(file_stem(F.col("_metadata.file_path")).alias("source_id"), F.col("value").alias("text"))


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """Path relative to ``path`` and length of every object; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    root = path.rstrip("/").split(":", 1)[-1].lstrip("/")
    start = F.instr("path", f"/{root}/") + len(root) + 2
    return files.select(F.substr("path", start).alias("path"), "length")


def object_exists(documents: DataFrame, objects: DataFrame, path: str) -> DataFrame:
    """Add ``exists``: whether the object named in column ``path`` is stored."""
    stored = objects.select(F.col("path").alias(path), F.lit(True).alias("exists"))
    return documents.join(stored, path, "left").withColumn("exists", F.coalesce("exists", F.lit(False)))
