"""Small DataFrame helpers the operators of this package share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from annalist.llm.arrays import SLICE, string_texts
from annalist.session import work_dir


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, name: str, row_group_mb: int = 0) -> DataFrame:
    """Write to the folder all executors share and read back: lineage ends there.

    ``row_group_mb`` bounds what a writer and a reader hold of rows with long arrays.
    """
    path = work_dir(df.sparkSession, name)
    writer = df.write
    if row_group_mb:
        writer = writer.option("parquet.block.size", row_group_mb << 20)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often it is named."""
    return F.transform(F.array(value), body).getItem(0)


def id_hash(column: str) -> Column:
    """crc32 of the decimal text of an id; null ids give null."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def with_results(documents: DataFrame, text: str, results: T.StructType, work, per_slice, slice_bytes: int = SLICE) -> DataFrame:
    """``row`` (a struct of all columns as they came) next to result columns computed in Python.

    ``per_slice(texts, work)`` gives one list or array (numpy, Arrow) per field of
    ``results`` for a list of strings, null read as empty. Rows stay in their partition, and
    since the columns travel in a struct no name can clash.
    """
    place = documents.columns.index(text)
    schema = T.StructType([T.StructField("row", documents.schema, True), *results.fields])

    def run(batches):
        for batch in batches:
            rows = batch.column(0)
            for start, stop, texts in string_texts(rows.field(place), slice_bytes):
                arrays = [rows.slice(start, stop - start)]
                for field, values in zip(results.fields, per_slice(texts, work), strict=True):
                    arrays.append(values if isinstance(values, pa.Array) else pa.array(values, to_arrow_type(field.dataType)))
                yield pa.RecordBatch.from_arrays(arrays, names=["row", *results.names])

    return documents.select(F.struct("*").alias("row")).mapInArrow(run, schema)
