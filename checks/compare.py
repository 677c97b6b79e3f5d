"""Run registered queries next to their SQL twins: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

from annalist.session import session
from checks.catalog import QUERIES, SQL

# Type families that must agree between both sides.
SPARK_KIND = {
    "string": "text", "boolean": "bool", "date": "date", "timestamp": "time", "timestamp_ntz": "time",
    "int": "int", "bigint": "long", "double": "double",
}
DUCK_KIND = {
    "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "time",
    "INTEGER": "int", "BIGINT": "long", "DOUBLE": "double",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def compare(df, connection, name: str) -> tuple[bool, str]:
    started = time.time()
    columns = sorted(df.columns)
    kinds = {f.name: SPARK_KIND.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rows = Counter(tuple(plain(row[c]) for c in columns) for row in df.toLocalIterator())
    took = time.time() - started
    if name not in SQL:
        return True, f"rows only: {sum(rows.values())} in {took:.1f}s"
    relation = connection.sql(SQL[name])
    if sorted(relation.columns) != columns:
        return False, f"columns {columns} <> {sorted(relation.columns)}"
    other = {c: DUCK_KIND.get(str(k), str(k)) for c, k in zip(relation.columns, relation.types, strict=True)}
    order = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    notes = [f"{c}: {kinds[c]}/{other[c]}" for c in columns if kinds[c] != other[c]]
    if rows != expected:
        extra, lacking = list((rows - expected).items())[:1], list((expected - rows).items())[:1]
        return False, f"{sum(rows.values())} rows, {sum(expected.values())} expected\n   spark {str(extra)[:900]}\n   sql   {str(lacking)[:900]}"
    return not notes, f"{sum(rows.values())} rows in {took:.1f}s {' '.join(notes)}"


def main(folder: str, names: list[str]) -> int:
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(folder)
    bad = 0
    for name in names or QUERIES:
        try:
            same, note = compare(QUERIES[name](spark, folder), connection, name)
        except Exception as error:  # report and go on with the next query
            same, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not same
        print("ok  " if same else "BAD ", name, note, flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    where = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    sys.exit(1 if main(where, arguments) else 0)
