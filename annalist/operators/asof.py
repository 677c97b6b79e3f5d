"""Join facts to the version that was in force at their time."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.operators.chains import HOT_KEY_ROWS, find_hot_keys


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def point_in_time(
    facts: DataFrame, versions: DataFrame, keys: list[str], time: str, columns: list[str], hot_limit: int = HOT_KEY_ROWS
) -> DataFrame:
    """Left join: each fact keeps its row and gets ``columns`` of the version in force.

    Periods of one key must not overlap. Facts and versions are ordered together
    within their key, and a fact takes the last version before it: linear work, no
    pairs. A key with more than ``hot_limit`` of both is cut into time ranges of
    counted size, so that a burst is spread like the rest; what a range inherits,
    the last version of the ranges before, comes from a summary of one row per
    range. So no range sees versions of another. A fact without a time or with a
    null in its key has no version in force and takes no part in the ordering.
    """
    whole = reduce(and_, [F.col(k).isNotNull() for k in [*keys, time]])
    known = list(dict.fromkeys([*columns, "valid_from", "valid_to"]))
    begun = versions.dropna(subset=[*keys, "valid_from"]).select(
        *keys, F.col("valid_from").cast("timestamp_ntz").alias("_time"), F.lit(1).alias("_kind"), F.struct(*known).alias("_state")
    )
    fact = F.struct(*facts.columns).alias("_fact")
    asking = facts.filter(whole).select(*keys, F.col(time).cast("timestamp_ntz").alias("_time"), F.lit(2).alias("_kind"), fact)
    rows = begun.unionByName(asking, allowMissingColumns=True).withColumn("_at", _micros(F.col("_time")))
    hot = find_hot_keys(rows, keys, hot_limit)
    cell = keys
    if hot is not None:
        cell = [*keys, "_range"]
        rows = hot.mark(rows, "_at")
        ranges = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        inherited = (
            rows.filter("_hot")
            .groupBy(*cell)
            .agg(F.max_by(F.when(F.col("_kind") == 1, F.col("_state")), F.when(F.col("_kind") == 1, F.col("_at"))).alias("_last"))
            .withColumn("_state", F.last("_last", ignorenulls=True).over(ranges))
            .select(*cell, F.lit(0).alias("_kind"), "_state")
        )
        rows = rows.drop("_hot").unionByName(inherited, allowMissingColumns=True)
    # What a range inherits has no time and comes first.
    ordered = Window.partitionBy(*cell).orderBy(F.col("_at").asc_nulls_first(), "_kind")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = F.last("_state", ignorenulls=True).over(so_far)
    in_force = F.col("_state.valid_to").isNull() | (F.col("_state.valid_to") > F.col("_time"))
    found = (
        rows.withColumn("_state", state)
        .filter("_kind = 2")
        .select("_fact.*", *[F.when(in_force, F.col(f"_state.{c}")).alias(c) for c in columns])
    )
    types = dict(versions.dtypes)
    lost = facts.filter(~whole).select("*", *[F.lit(None).cast(types[c]).alias(c) for c in columns])
    return found.unionAll(lost)
