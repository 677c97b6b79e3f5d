"""Global shuffle into shards by a two-pass external shuffle.

Pass one scatters rows uniformly, by seeded hashes, into buckets that fit in a
task's memory; pass two permutes each bucket (Fisher-Yates, seeded per bucket).
The buckets in order, each in its permuted order, are a random order of all rows.
Row p of that order goes to shard ``p mod shards``, slot ``p div shards``, so the
shards' counts are at most one apart.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.session import work_dir

BUCKET_BYTES = 32 << 20
#: Most buckets; beyond that they grow, so that the table of their offsets stays small.
MOST_BUCKETS = 1 << 20
LAW = "rows"


def _permuted(seed: int):
    def run(key, rows):
        bucket, part = (int(x.as_py()) for x in key)
        # Shuffles deliver rows in any order: a fixed one first, so that a task run again gives the same.
        order = np.lexsort((np.array(rows["_also"]), np.array(rows["_hash"])))
        # Fisher-Yates: every order of the bucket is equally likely.
        order = order[np.random.default_rng([seed, bucket, part]).permutation(len(order))]
        taken = rows.select(["_row", "_bucket", "_part"]).take(pa.array(order))
        return taken.append_column("_place", pa.array(np.arange(len(order))))

    return run


def scattered(rows: DataFrame, id_column: str, text: str, seed: int, bucket_bytes: int) -> DataFrame:
    """``_row, _hash, _also, _bucket, _part``: the rows with the bucket they go to.

    The bucket follows from seed and id alone. Where many rows repeat one id
    their bucket would outgrow a task, so it is cut into parts by the partition
    a row is read from.
    """
    total = rows.agg(F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1)).first()[0] or 1
    limit = max(bucket_bytes, math.ceil(total / MOST_BUCKETS))
    buckets = max(1, math.ceil(total / limit))
    hashable = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(id_column)), F.lit(buckets).cast("long"))
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1
    out = rows.select(
        F.struct("*").alias("_row"), F.xxhash64(F.col(id_column)).alias("_hash"), F.xxhash64(*[F.col(f"`{n}`") for n in hashable]).alias("_also"), bucket.alias("_bucket"), size.alias("_size")
    )
    heavy = out.groupBy("_bucket").agg(F.sum("_size").alias("bytes")).where(F.col("bytes") > 4 * limit)
    heavy = heavy.select("_bucket", F.ceil(F.col("bytes") / limit).alias("_parts"))
    if heavy.isEmpty():
        return out.drop("_size").withColumn("_part", F.lit(0).cast("long"))
    # At most MOST_BUCKETS / 4 rows, each standing for over 4 * limit bytes.
    cut = out.join(F.broadcast(heavy), "_bucket", "left")
    part = F.pmod(F.xxhash64(F.lit(seed), F.spark_partition_id()), F.col("_parts"))
    return cut.select("_row", "_hash", "_also", "_bucket", F.coalesce(part, F.lit(0).cast("long")).alias("_part"))


def shuffled(documents: DataFrame, shards: int = 8, seed: int = 0, id_column: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``row, shard, slot``: every row of a stable table once, with its place in a random order.

    Slots count from 0 in each shard without a gap. Order and shards depend on
    the rows, the seed and the bucket size only. Null ids and null texts count as
    values; repeated rows are placed one by one.
    """
    rows = scattered(documents, id_column, text, seed, bucket_bytes)
    counts = rows.groupBy("_bucket", "_part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket: at most MOST_BUCKETS and the parts of heavy ones.
    offsets = counts.select("_bucket", "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    schema = T.StructType(
        [T.StructField("_row", documents.schema, False), T.StructField("_bucket", T.LongType()), T.StructField("_part", T.LongType()), T.StructField("_place", T.LongType())]
    )
    permuted = rows.groupBy("_bucket", "_part").applyInArrow(_permuted(seed), schema)
    position = F.col("_before") + F.col("_place")
    placed = permuted.join(F.broadcast(offsets), ["_bucket", "_part"]).select(F.col("_row").alias("row"), position.alias("p"))
    return placed.select("row", (F.col("p") % shards).cast("int").alias("shard"), F.floor(F.col("p") / shards).cast("long").alias("slot"))


def write_shards(documents: DataFrame, path: str, shards: int = 8, seed: int = 0, id_column: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write Parquet folders ``shard=k`` with the rows in order of their slots in every file; reads them back as ``row, slot, shard``."""
    placed = shuffled(documents, shards, seed, id_column, text, bucket_bytes)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    schema = T.StructType([T.StructField("row", documents.schema), T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return documents.sparkSession.read.schema(schema).parquet(path)


def shard_folder(documents: DataFrame) -> str:
    """A fresh place for shards below the shared folder."""
    return work_dir(documents.sparkSession, "shards")
