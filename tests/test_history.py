import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from annalist import schemas
from annalist.operators import asof, chains, doctypes, history

T1, T2 = "2024-02-01 00:00:00", "2025-03-01 00:00:00"
STATE = history.HistorySpec(["k"], ["v"], ["path"], versioned=True)
STORED = (
    "k STRING, v STRING, other INT, path STRING, content_hash STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, "
    "is_current BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, version_id STRING"
)
BATCH = "k STRING, v STRING, other INT, path STRING, seq LONG"


def moment(text):
    return dt.datetime.fromisoformat(text)


def model(stored, batch, now):
    """Row by row: returns the stored versions and the action per batch row."""
    rows, actions = [dict(r) for r in stored], []
    opened = {}
    for k, v, other, path, seq in sorted(batch, key=lambda r: r[4]):
        live = next((r for r in rows if r["k"] == k and r["valid_to"] is None), None)
        if live is not None and live["v"] == v:
            live["path"] = path
            live["updated_at"] = moment(now)
            actions.append((k, seq, "unchanged"))
            continue
        start = moment(now) + dt.timedelta(microseconds=opened.get(k, 0))
        opened[k] = opened.get(k, 0) + 1
        if live is not None:
            live["valid_to"] = start
            live["updated_at"] = moment(now)
        actions.append((k, seq, "insert" if live is None else "update"))
        rows.append(
            {"k": k, "v": v, "other": other, "path": path, "valid_from": start, "valid_to": None,
             "created_at": moment(now), "updated_at": moment(now)}
        )
    return rows, actions


COLUMNS = ["k", "v", "other", "path", "valid_from", "valid_to", "created_at", "updated_at"]


def as_set(rows):
    return sorted(tuple(str(r[c]) for c in COLUMNS) for r in rows)


@pytest.mark.parametrize("limit", [1, 5, 100_000])
def test_merge_equals_row_by_row(spark, limit):
    source = random.Random(limit)
    keys = [f"k{i}" for i in range(20)]

    def batch(size):
        # One key holds a third of the rows, and values come back.
        return [
            (keys[0] if source.random() < 0.34 else source.choice(keys), source.choice("xyz"), i, f"p{i}", i)
            for i in range(size)
        ]

    first, second = batch(120), batch(150)
    empty = spark.createDataFrame([], STORED)
    b1, b2 = spark.createDataFrame(first, BATCH).repartition(3), spark.createDataFrame(second, BATCH).repartition(3)

    h1 = history.merge(empty, b1, STATE, T1, hot_limit=limit)
    h1 = spark.createDataFrame(h1.collect(), h1.schema)
    rows1, actions1 = model([], first, T1)
    assert as_set(h1.collect()) == as_set(rows1)
    got = history.merge_actions(empty, b1, STATE, hot_limit=limit).select("k", "seq", "action").collect()
    assert sorted(tuple(r) for r in got) == sorted(actions1)

    current = [r for r in rows1 if r["valid_to"] is None]
    h2 = history.merge(h1, b2, STATE, T2, hot_limit=limit)
    h2 = spark.createDataFrame(h2.collect(), h2.schema)
    rows2, actions2 = model(current, second, T2)
    assert as_set(h2.collect()) == as_set(rows2)
    got = history.merge_actions(h1, b2, STATE, hot_limit=limit).select("k", "seq", "action").collect()
    assert sorted(tuple(r) for r in got) == sorted(actions2)

    everything = h1.filter(~F.col("is_current")).unionByName(h2)
    assert history.repeated_current_keys(everything, ["k"]).isEmpty()
    assert history.overlapping_periods(everything, ["k"], hot_limit=limit).isEmpty()
    assert history.repeated_keys(everything, ["version_id"]).isEmpty()


def test_rerun_changes_nothing(spark):
    rows = [("a", "x", 1, "p", 0), ("b", "y", 2, "q", 1)]
    batch = spark.createDataFrame(rows, BATCH)
    stored = history.merge(spark.createDataFrame([], STORED), batch, STATE, T1)
    actions = history.action_counts(history.merge_actions(stored, batch, STATE)).first()
    assert tuple(actions) == (0, 0, 2)
    again = history.merge(stored, batch, STATE, T2)
    assert {r["valid_from"] for r in again.collect()} == {moment(T1)}


def test_values_outside_the_hash_are_not_stored(spark):
    first = spark.createDataFrame([("a", "x", 1, "p", 0)], BATCH)
    second = spark.createDataFrame([("a", "x", 2, "q", 0)], BATCH)
    stored = history.merge(spark.createDataFrame([], STORED), first, STATE, T1)
    row = history.merge(stored, second, STATE, T2).first()
    assert (row["other"], row["path"], row["updated_at"]) == (1, "q", moment(T2))


def test_batch_names_a_key_four_times(spark):
    values = ["x", "y", "y", "x"]
    batch = spark.createDataFrame([("A", v, 0, "p", i) for i, v in enumerate(values)], BATCH)
    empty = spark.createDataFrame([], STORED)
    actions = history.merge_actions(empty, batch, STATE).orderBy("seq").select("action").collect()
    assert [r[0] for r in actions] == ["insert", "update", "unchanged", "update"]
    versions = history.key_history(history.merge(empty, batch, STATE, T1), k="A").collect()
    assert [r["v"] for r in versions] == ["x", "y", "x"]
    assert [r["is_current"] for r in versions] == [True, False, False]


def test_overlaps_are_found(spark):
    rows = [
        ("a", moment("2024-01-01"), moment("2024-01-03")),
        ("a", moment("2024-01-02"), moment("2024-01-05")),
        ("a", moment("2024-01-05"), None),
        ("b", moment("2024-01-01"), None),
        ("b", moment("2024-02-01"), None),
    ]
    df = spark.createDataFrame(rows, "k STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ")
    for limit in (1, 100):
        found = history.overlapping_periods(df, ["k"], hot_limit=limit).select("k", "valid_from").collect()
        assert sorted(tuple(r) for r in found) == [("a", moment("2024-01-01")), ("b", moment("2024-01-01"))]


def test_as_of_bounds(spark):
    df = spark.createDataFrame(
        [("a", moment("2024-01-01"), moment("2024-02-01")), ("a", moment("2024-02-01"), None)],
        "k STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ",
    )
    def count(time):
        return [r["valid_from"] for r in history.as_of(df, time).collect()]

    assert count("2023-12-31") == []
    assert count("2024-01-01") == [moment("2024-01-01")]
    assert count("2024-02-01") == [moment("2024-02-01")]


def test_types_merge(spark):
    def listed(*rows):
        return spark.createDataFrame(list(rows), "version_id STRING, type_ids ARRAY<INT>")

    def state(df):
        return sorted((r["version_id"], r["type_id"], r["is_current"]) for r in df.collect())

    empty = spark.createDataFrame([], schemas.DOCUMENT_TYPES)
    merged = spark.createDataFrame([("a", [1, 2, 2]), ("b", [1]), ("c", [])], "version_id STRING, type_ids ARRAY<INT>")
    first = doctypes.merge_types(empty, doctypes.listed_types(merged), T1)
    assert state(first) == [("a", 1, True), ("a", 2, True), ("b", 1, True)]
    second = doctypes.merge_types(first, doctypes.listed_types(listed(("a", [2, 3]), ("b", []))), T2)
    assert state(second) == [("a", 1, False), ("a", 2, True), ("a", 3, True), ("b", 1, True)]
    # An empty list leaves its version alone, too, if it was not taken out before.
    assert state(doctypes.merge_types(first, listed(("a", [2, 3]), ("b", []), ("d", None)), T2)) == state(second)
    delta = doctypes.type_delta(first, listed(("a", [2, 3])))
    assert sorted(tuple(r) for r in delta.collect()) == [("a", 1, "close"), ("a", 3, "open")]


@pytest.mark.parametrize("limit", [100_000, 100, 5])
def test_point_in_time_equals_brute_force(spark, limit):
    source = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    versions, facts = [], []
    for key in range(6):
        starts = sorted({base + dt.timedelta(minutes=source.randint(0, 6000)) for _ in range(60 if key == 0 else 8)})
        for i, start in enumerate(starts):
            end = starts[i + 1] if i + 1 < len(starts) else None
            if end is not None and source.random() < 0.3:  # a gap before the next one
                end = start + (end - start) / 2
            versions.append((key, f"{key}-{i}", start, end))
    for i in range(600):
        facts.append((i, 0 if source.random() < 0.34 else source.randint(0, 7), base + dt.timedelta(minutes=source.randint(-50, 6500))))
    expected = sorted(
        (i, k, next((n for vk, n, s, e in versions if vk == k and s <= at and (e is None or e > at)), None))
        for i, k, at in facts
    ) + [(600, 1, None), (601, None, None), (602, None, None)]
    facts += [(600, 1, None), (601, None, base), (602, None, None)]
    versions.append((None, "no key", base, None))
    v = spark.createDataFrame(versions, "k INT, name STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ")
    f = spark.createDataFrame(facts, "i INT, k INT, at TIMESTAMP_NTZ").repartition(3)
    got = asof.point_in_time(f, v, ["k"], "at", ["name"], limit).select("i", "k", "name").collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == expected


def test_newest_per_key_and_hot_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k STRING, n INT, v STRING")
    assert sorted(map(tuple, chains.newest_per_key(df, ["k"], ["n"]).collect())) == [("a", 3, "z"), ("b", 1, None)]
    hot = chains.find_hot_keys(df, ["k"], 2)
    assert (hot.count, [r[0] for r in hot.keys.collect()]) == (1, ["a"])
    assert chains.find_hot_keys(df, ["k"], 3) is None


def test_sparse_orders_give_few_ranges(spark):
    """A key with one row a minute is cut by its rows, not by its microseconds."""
    from annalist.operators.chains import find_hot_keys, with_next

    rows = spark.range(20_000).select(F.lit("a").alias("key"), (F.col("id") * 60_000_000).alias("at")).union(spark.sql("SELECT 'b', 5L"))
    hot = find_hot_keys(rows, ["key"], 1000)
    sizes = [r["count"] for r in hot.mark(rows, "at").filter("_hot").groupBy("_range").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 1001
    following = with_next(rows, ["key"], "at", hot)
    assert following.filter("key = 'a' AND _next = at + 60000000").count() == 19_999
    assert following.filter("_next IS NULL").count() == 2


@pytest.mark.parametrize("spread", [1, 1_000_000])
def test_crowded_orders_are_cut_by_their_count(spark, spread):
    """Nearly all rows of a key in 20 seconds, one far before them, and none without a range."""
    crowd = spark.range(19_999).select(F.lit("a").alias("key"), (F.lit(1_700_000_000_000_000) + F.col("id") * (1000 // spread + 1)).alias("at"))
    rows = crowd.union(spark.sql("SELECT 'a', 0L UNION ALL SELECT 'b', 5L")).union(
        spark.range(5000).select(F.lit(None).cast("string"), F.col("id") * spread)
    )
    hot = chains.find_hot_keys(rows, ["key"], 1000)
    assert hot.count == 2
    marked = hot.mark(rows, "at")
    assert marked.count() == rows.count()
    sizes = marked.filter("_hot").groupBy("key", "_range").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).collect()
    assert max(r["n"] for r in sizes) <= 1001 and len(sizes) <= 40
    for key in ("a", None):
        spans = sorted((r["_range"], r["low"], r["high"]) for r in sizes if r["key"] == key)
        assert all(b[1] > a[2] for a, b in zip(spans[:-1], spans[1:], strict=True))
    following = chains.with_next(rows, ["key"], "at", hot)
    assert following.filter("_next IS NULL").count() == 3
    assert following.filter("key = 'a' AND at > 0").agg(F.sum(F.col("_next") - F.col("at"))).first()[0] == 19_998 * (1000 // spread + 1)


def test_rows_of_one_order_stay_in_one_range(spark):
    rows = spark.range(3000).select(F.lit("a").alias("key"), F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).cast("long").alias("at"))
    sizes = {r["_range"]: r["count"] for r in chains.find_hot_keys(rows, ["key"], 100).mark(rows, "at").groupBy("_range").count().collect()}
    assert sorted(sizes.values())[-1] == 2000 and sorted(sizes.values())[-2] <= 101
