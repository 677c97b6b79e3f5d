"""Raw and processed areas in two partition layouts.

A batch writes the new content of the partitions it touches beside the old one, in
folders ``commit=n`` of its own, and then a manifest that names the commit each
partition is to be read from. The manifest's marker is the switch: a job that dies
before it leaves the area as it was, and no folder is ever overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.functions.paths import TEXT_SUFFIX
from annalist.operators.chains import join_alike, newest_per_key, written
from annalist.sinks.files import child_names, claim, marked

REVISION_PARTS = ["source", "year", "month", "day"]
COLLECTION_PARTS = ["date", "source"]
MANIFEST = "_manifest"
# Lists of stored keys that stay are sent to all tasks up to this length (some 100 bytes each).
BROADCAST_STAY = 500_000
RAW_COLUMNS = ["source", "source_id", "revision_date", "collection_date", "text", "raw_metadata", "seq"]
PROCESSED_COLUMNS = ["source", "source_id", "revision_date", "collection_date", "markdown", "seq"]


def by_revision(df: DataFrame) -> DataFrame:
    """Partition columns as text, so that months keep their leading zero."""
    return (
        df.withColumn("year", F.year("revision_date").cast("string"))
        .withColumn("month", F.date_format("revision_date", "MM"))
        .withColumn("day", F.date_format("revision_date", "dd"))
    )


def by_collection(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.col("collection_date").cast("string"))


def _in_force(spark: SparkSession, path: str, parts: list[str]) -> DataFrame | None:
    """The commit each partition is read from, one row per partition; none before the first commit."""
    commits = marked(spark, f"{path}/{MANIFEST}", "_SUCCESS")
    if not commits:
        return None
    schema = ", ".join(f"{p} STRING" for p in parts)
    return spark.read.schema(f"{schema}, commit INT").parquet(f"{path}/{MANIFEST}/commit={commits[-1]}")


def read_area(like: DataFrame, path: str, parts: list[str]) -> DataFrame:
    """Read an area with the columns of ``like``, partition values as text.

    The manifest, a row per partition, is joined on the partition columns, which
    prunes the scan to the folders in force.
    """
    schema = ", ".join(
        f"{f.name} {'STRING' if f.name in parts else f.dataType.simpleString()}" for f in like.schema.fields
    )
    spark = like.sparkSession
    held = _in_force(spark, path, parts)
    if held is None:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(f"{schema}, commit INT").parquet(path)
    return stored.join(held, [*parts, "commit"], "left_semi").drop("commit")


def put(df: DataFrame, path: str, parts: list[str], keys: list[str]) -> None:
    """Write rows as objects: a row replaces the stored one with the same key.

    Only partitions the batch touches are written anew. Hot partitions are split
    over several files, small ones share a task.
    """
    spark = df.sparkSession
    # Texts are shuffled to find the newest row of a key only where a key repeats.
    repeats = not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    batch = newest_per_key(df, keys, ["seq"]) if repeats else df
    # One row per touched partition: days times sources. Written, so that its size is known before stored texts meet it.
    touched = written(df.select(*parts).distinct(), "touched")
    held = _in_force(spark, path, parts)
    if held is not None:
        stored = read_area(df, path, parts).join(touched, parts, "left_semi")
        # Keys tell which stored rows stay, so that the texts of the others are not moved.
        stay = written(stored.select(*keys).join(df.select(*keys).distinct(), keys, "left_anti").distinct(), "stay")
        listed = F.broadcast(stay) if stay.count() <= BROADCAST_STAY else stay
        batch = batch.unionByName(join_alike(stored, listed, keys, "left_semi"))
    number = max([int(n) for n in child_names(spark, f"{path}/{MANIFEST}/_claims") if n.isdigit()], default=0) + 1
    if not claim(spark, f"{path}/{MANIFEST}/_claims/{number}"):
        raise ValueError(f"commit {number} is being written by another job")
    content = next(c for c in ("text", "markdown") if c in df.columns)
    rows = batch.withColumn("n_bytes", F.octet_length(content).cast("long")).withColumn("commit", F.lit(number))
    rows.hint("rebalance", *parts).write.mode("append").option("compression", "zstd").partitionBy(*parts, "commit").parquet(path)
    now = touched.withColumn("commit", F.lit(number))
    if held is not None:
        now = now.unionByName(held.join(touched, parts, "left_anti"))
    now.coalesce(1).write.parquet(f"{path}/{MANIFEST}/commit={number}")


def save_dual(documents: DataFrame, root: str, columns: list[str]) -> None:
    """Write one batch in both layouts below ``root``.

    ``documents`` should be a stored table, as it is read once per layout. A
    document whose revision date moved keeps its earlier revision object.
    """
    rows = documents.select(*columns)
    put(by_revision(rows), f"{root}/by_revision", REVISION_PARTS, ["source", "source_id", "year", "month", "day"])
    put(by_collection(rows), f"{root}/by_collection", COLLECTION_PARTS, ["source", "source_id", "date"])


def inventory(spark: SparkSession, root: str, suffix: str = TEXT_SUFFIX) -> DataFrame:
    """``path, length`` of every object in both layouts below ``root``, as :func:`list_objects` gives them.

    The sink keeps each object's size beside its content, so this reads two narrow
    columns and lists no objects; it is as large as the area and stays distributed.
    """
    found = []
    for area, parts in (("by_revision", REVISION_PARTS), ("by_collection", COLLECTION_PARTS)):
        names = list(dict.fromkeys(["source", "source_id", *parts]))
        like = spark.createDataFrame([], ", ".join(f"{n} STRING" for n in names) + ", n_bytes BIGINT")
        folders = [F.concat(F.lit(f"{p}="), F.col(p)) for p in parts]
        path = F.concat_ws("/", F.lit(area), *folders, F.concat("source_id", F.lit(suffix)))
        found.append(read_area(like, f"{root}/{area}", parts).select(path.alias("path"), F.col("n_bytes").alias("length")))
    return found[0].unionByName(found[1])


def save_raw(documents: DataFrame, root: str) -> None:
    save_dual(documents.filter(F.col("text").isNotNull()), root, RAW_COLUMNS)


def save_processed(rendered: DataFrame, root: str) -> None:
    save_dual(rendered.filter(F.col("outcome") == "success"), root, PROCESSED_COLUMNS)


def read_revisions(area: DataFrame, first: str, last: str) -> DataFrame:
    """Rows whose revision date lies in a range, pruning ``year=`` folders as well."""
    first_day, last_day = F.lit(first).cast("date"), F.lit(last).cast("date")
    year = F.col("year").cast("int")
    return area.filter(
        year.between(int(first[:4]), int(last[:4])) & F.col("revision_date").between(first_day, last_day)
    )
