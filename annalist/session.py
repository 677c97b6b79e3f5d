"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "annalist", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs were planned for.

    Shuffle partitions are left to the cluster: AQE coalesces them, so a large
    initial number costs little and a small one would not survive large inputs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used in local mode only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="annalist-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never one that was used before."""
    return f"{shared_folder(spark)}/annalist/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise through a reliable checkpoint, so a lost executor loses nothing."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core a share of a small scan whose rows cost much to process.

    Scans with at least as many splits as cores, as any large table has, are
    left as they are. ``df`` must be a plain scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
