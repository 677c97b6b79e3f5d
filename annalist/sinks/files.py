"""Small questions to the file system that holds the tables, and files of given names."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

# What Spark escapes in the names of partition folders.
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def _path(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _path(spark, path)
    return system.exists(location)


def child_names(spark: SparkSession, path: str) -> list[str]:
    system, location = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(location)) if system.exists(location) else []


def marked(spark: SparkSession, path: str, marker: str) -> list[int]:
    """Numbers ``n`` of the folders ``commit=n`` below ``path`` that hold ``marker``, by one listing."""
    system, location = _path(spark, f"{path}/commit=*/{marker}")
    depth = len(marker.split("/"))
    names = []
    for status in system.globStatus(location) or []:
        folder = status.getPath()
        for _ in range(depth):
            folder = folder.getParent()
        names.append(int(folder.getName().removeprefix("commit=")))
    return sorted(names)


def remove(spark: SparkSession, path: str) -> None:
    system, location = _path(spark, path)
    system.delete(location, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already. Of two callers one wins, where the file system creates atomically."""
    system, location = _path(spark, path)
    try:
        system.create(location, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def put_files(rows: DataFrame, folder: str, path: str) -> None:
    """One file a row below ``path``: ``value`` as ``name``, in the partition folder of column ``folder``.

    Spark's writers give a file a folder of its own if its name is to say what it
    holds, and on local disks start three processes for folder, file and checksum.
    Here a task writes its files one by one, by Arrow's file systems. Names must
    differ within a folder; a task that is run again writes the same files anew.
    """
    system, location = _path(rows.sparkSession, path)
    system.mkdirs(location)
    root = re.sub("^file:/+", "file:///", system.makeQualified(location).toString())

    def put(part) -> None:
        target, base = fs.FileSystem.from_uri(root)
        made = set()
        for row in part:
            value = _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", row[folder] or "")
            below = f"{base}/{folder}={value or '__HIVE_DEFAULT_PARTITION__'}"
            if below not in made:
                target.create_dir(below, recursive=True)
                made.add(below)
            with target.open_output_stream(f"{below}/{row['name']}") as out:
                out.write((row["value"] or "").encode())

    rows.select(folder, "name", "value").foreachPartition(put)
