"""Which stored objects have outlived their use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.functions.values import partition_day

# Fixed value: days a temporary artefact is kept.
RETENTION_DAYS = 7


def expired(objects: DataFrame, as_of: str, days: int = RETENTION_DAYS) -> DataFrame:
    """Objects in a ``date=`` folder older than ``as_of`` minus ``days``.

    Paths are relative to the area. Malformed dates and other folders are kept.
    """
    cutoff = F.date_sub(F.lit(as_of).cast("date"), days)
    return objects.withColumn("partition_date", partition_day(F.col("path"))).filter(F.col("partition_date") < cutoff)


def expired_days(objects: DataFrame, as_of: str, days: int = RETENTION_DAYS) -> DataFrame:
    """The ``date=`` folders to drop, with the objects each holds."""
    return expired(objects, as_of, days).groupBy("partition_date").agg(F.count(F.lit(1)).alias("objects"))


def delete_expired(root: str, objects: DataFrame, as_of: str, days: int = RETENTION_DAYS, dry_run: bool = True) -> int:
    """Drop expired ``date=`` folders below ``root``; returns the objects concerned.

    Whole folders are dropped, one call per day, so the driver sees days and
    never single objects. A dry run only counts.
    """
    spark = objects.sparkSession
    total = 0
    for row in expired_days(objects, as_of, days).toLocalIterator():
        total += row["objects"]
        if not dry_run:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/date={row['partition_date'].isoformat()}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return total


def cold(processed: DataFrame, year: int, years: int = 2) -> DataFrame:
    """Processed revisions older than ``years`` years; prunes whole ``year=`` folders."""
    return processed.filter(F.col("year").cast("int") < year - years)
