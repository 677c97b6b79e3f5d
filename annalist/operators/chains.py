"""Ordered work per key that stays bounded when one key holds a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.session import work_dir

# A key with more rows than this is cut into order ranges of about so many rows.
HOT_KEY_ROWS = 500_000
# Lists of hot keys up to this length are broadcast, longer ones are joined.
BROADCAST_KEYS = 100_000
# Tables of range starts (8 bytes each) up to this many starts are broadcast.
BROADCAST_STARTS = 2_000_000
# Orders are counted in at most 2^FIRST_BITS cells; cells on a border between ranges in 2^MORE_BITS smaller ones, and so on.
FIRST_BITS, MORE_BITS = 12, 8
# Borders are exact up to this share of a range.
BORDER_SHARE = 1 / 1000


def join_alike(left: DataFrame, right: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """Join on equal values of ``names``, where null equals null; the columns of ``left`` first, ``names`` once."""
    hidden = right.select(*[F.col(n).alias(f"_of_{n}") if n in names else F.col(n) for n in right.columns])
    same = reduce(and_, [left[n].eqNullSafe(hidden[f"_of_{n}"]) for n in names])
    return left.join(hidden, same, how).drop(*[f"_of_{n}" for n in names])


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than ``limit`` rows, and how many such keys there are."""

    keys: DataFrame
    count: int
    limit: int

    def mark(self, rows: DataFrame, order: str) -> DataFrame:
        """Add ``_hot`` and ``_range``, the order range a row of a hot key falls in.

        Ranges hold ``limit`` rows, give or take BORDER_SHARE, wherever orders crowd;
        only rows of one order stay together. The starts of a key's ranges come with its
        rows as one sorted array, in which a row finds its range by halving.
        """
        starts, total = self._starts(rows, order)
        if total <= BROADCAST_STARTS:
            starts = F.broadcast(starts)
        # The steps halve: any array shorter than the sum of all of them is covered.
        steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(max(total, 1).bit_length()))])

        def forward(place: Column, step: Column) -> Column:
            further = (place + step <= F.size("_starts")) & (F.get("_starts", place + step - 1) <= F.col(order))
            return F.when(further, place + step).otherwise(place)

        place = F.aggregate(steps, F.lit(0), forward).cast("long")
        marked = join_alike(rows, starts.withColumn("_hot", F.lit(True)), self.keys.columns)
        return marked.withColumn("_range", F.when(F.col("_hot"), place).otherwise(F.lit(0).cast("long"))).drop("_starts")

    def _starts(self, rows: DataFrame, order: str) -> tuple[DataFrame, int]:
        """Per hot key the orders at which its ranges after the first begin, and how many there are in all.

        Rows are counted per key and cell of orders, combined before the shuffle, and
        running counts over the cells of a key tell which ranges a cell lies in. Only
        cells on a border between ranges are counted again in smaller cells: there
        are no more of them than borders.
        """
        names, spare = self.keys.columns, self.limit * BORDER_SHARE
        keys = F.broadcast(self.keys) if self.count <= BROADCAST_KEYS else self.keys
        todo = join_alike(rows.select(*names, F.col(order).alias("_at")), keys, names, "left_semi").filter(F.col("_at").isNotNull())
        low, high = todo.agg(F.min("_at"), F.max("_at")).first()
        shift = max(0, (high - low).bit_length() - FIRST_BITS) if low is not None else 0
        todo = todo.withColumn("_outer", F.lit(0).cast("long")).withColumn("_base", F.lit(0).cast("long"))
        leaves = []
        while True:
            cells = todo.withColumn("_cell", F.shiftright("_at", shift))
            counted = cells.groupBy(*names, "_outer", "_base", "_cell").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_start"))
            before = Window.partitionBy(*names, "_outer").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
            counted = counted.withColumn("_before", F.col("_base") + F.coalesce(F.sum("_n").over(before), F.lit(0)))
            first, last = F.floor(F.col("_before") / self.limit), F.floor((F.col("_before") + F.col("_n") - 1) / self.limit)
            border = (first < last) & (F.col("_n") > spare) if shift else F.lit(False)
            counted = written(counted.withColumn("_range", first).withColumn("_border", border), "order-cells")
            leaves.append(counted.filter(~F.col("_border")).select(*names, "_range", "_start"))
            cut = counted.filter("_border").select(*names, "_cell", F.col("_before").alias("_base"))
            number = cut.count() if shift else 0
            if not number:
                break
            listed = F.broadcast(cut) if number <= BROADCAST_KEYS else cut
            todo = join_alike(cells.drop("_base", "_outer"), listed, [*names, "_cell"], "inner").withColumnRenamed("_cell", "_outer")
            shift = max(0, shift - MORE_BITS)
        first = reduce(DataFrame.unionByName, leaves).groupBy(*names, "_range").agg(F.min("_start").alias("_start"))
        # The first range of a key needs no start.
        later = F.array_sort(F.collect_list(F.when(F.col("_range") > 0, F.col("_start"))))
        starts = written(first.groupBy(*names).agg(later.alias("_starts")), "range-starts")
        return starts, starts.agg(F.coalesce(F.sum(F.size("_starts")), F.lit(0))).first()[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, as several plans read it."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def find_hot_keys(df: DataFrame, keys: list[str], limit: int = HOT_KEY_ROWS) -> HotKeys | None:
    """Count rows per key (combined before the shuffle) and keep the large ones."""
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > limit)
        .select(*keys)
    )
    count = hot.count()
    return HotKeys(hot, count, limit) if count else None


def number_changes(
    rows: DataFrame, keys: list[str], order: str, value: str, starts: Column, hot: HotKeys | None = None
) -> DataFrame:
    """Add ``_first``, ``_changed`` and ``_version`` to rows ordered within their key.

    A row is changed if its ``value`` differs from the one before it in the same
    key; for the first row of a key ``starts`` decides. ``_version`` is the
    number of changed rows so far. ``order`` is a whole number, unique in a key.

    Hot keys are cut into order ranges of about ``limit`` rows; the state
    between ranges travels through one summary row per range.
    """
    if hot is None:
        return _changes_in(rows, Window.partitionBy(*keys).orderBy(order), value, starts)

    window = Window.partitionBy(*keys, "_range").orderBy(order)
    local = _changes_in(hot.mark(rows, order), window, value, starts)
    ranges = Window.partitionBy(*keys).orderBy("_range")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        local.filter("_hot")
        .groupBy(*keys, "_range")
        .agg(
            F.min_by(value, order).alias("_head"),
            F.max_by(value, order).alias("_tail"),
            F.max("_version").alias("_count"),
        )
        .withColumn("_opens", F.row_number().over(ranges) == 1)
        .withColumn("_joins", ~F.col("_opens") & (F.lag("_tail").over(ranges) == F.col("_head")))
        .withColumn("_net", F.col("_count") - F.col("_joins").cast("long"))
        .select(
            *keys,
            "_range",
            "_opens",
            "_joins",
            (F.coalesce(F.sum("_net").over(before), F.lit(0)) - F.col("_joins").cast("long")).alias("_shift"),
        )
    )
    return (
        join_alike(local, edges, [*keys, "_range"])
        .withColumn("_changed", F.col("_changed") & ~(F.col("_first") & F.coalesce("_joins", F.lit(False))))
        .withColumn("_version", F.col("_version") + F.coalesce("_shift", F.lit(0)))
        .withColumn("_first", F.col("_first") & F.coalesce("_opens", F.lit(True)))
        .drop("_hot", "_range", "_opens", "_joins", "_shift")
    )


def _changes_in(rows: DataFrame, window: Window, value: str, starts: Column) -> DataFrame:
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_first", F.row_number().over(window) == 1)
        .withColumn("_changed", F.when(F.col("_first"), starts).otherwise(F.lag(value).over(window) != F.col(value)))
        .withColumn("_version", F.sum(F.col("_changed").cast("long")).over(so_far))
    )


def with_next(rows: DataFrame, keys: list[str], order: str, hot: HotKeys | None = None) -> DataFrame:
    """Add ``_next``, the ``order`` of the row that follows in the same key."""
    if hot is None:
        return rows.withColumn("_next", F.lead(order).over(Window.partitionBy(*keys).orderBy(order)))

    inside = Window.partitionBy(*keys, "_range").orderBy(order)
    local = hot.mark(rows, order).withColumn("_next", F.lead(order).over(inside))
    ranges = Window.partitionBy(*keys).orderBy("_range")
    edges = (
        local.filter("_hot")
        .groupBy(*keys, "_range")
        .agg(F.min(order).alias("_start"))
        .select(*keys, "_range", F.lead("_start").over(ranges).alias("_start_of_next"))
    )
    return (
        join_alike(local, edges, [*keys, "_range"])
        .withColumn("_next", F.coalesce("_next", "_start_of_next"))
        .drop("_hot", "_range", "_start_of_next")
    )


def newest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last by ``order``. Copies collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)
