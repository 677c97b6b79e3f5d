"""Best-fit packing of token pieces into sequences of one size.

Only the lengths of pieces decide how they pack, and there are at most as many
lengths as a sequence has tokens. So the packing is worked out on counts per
length, a table of bounded size however large the corpus: a bin is filled
greedily, longest first; then its smallest piece gives way to two that together
fill the widened gap better (best two fit); and the bin's pattern is used as
often as the counts allow. Pieces then find their place by their rank among the
pieces of equal length, which counts per task give without a sort of the whole.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.llm.arrays import string_texts
from annalist.llm.frames import stage
from annalist.llm.tokens import encoder

CAPACITY = 1024
END_ID = 2


def _largest_up_to(left: np.ndarray) -> np.ndarray:
    """For each size the largest length at hand that fits it, 0 for none."""
    at_hand = np.where(left > 0, np.arange(len(left)), 0)
    return np.maximum.accumulate(at_hand)


def _fill(left: np.ndarray, capacity: int) -> list[int]:
    """One bin from the counts at hand, which it lowers."""
    bin_, gap = [], capacity
    while length := int(_largest_up_to(left)[gap]):
        bin_.append(length)
        left[length] -= 1
        gap -= length
    while gap and len(bin_) > 1:
        smallest = bin_[-1]
        room = gap + smallest
        fits = _largest_up_to(left)
        first = np.flatnonzero(left[: room + 1])
        second = np.minimum(fits[np.maximum(room - first, 0)], first)
        # Two of one length need two of them.
        twice = (second == first) & (left[first] < 2)
        second[twice] = fits[np.maximum(first[twice] - 1, 0)]
        sums = np.where(second > 0, first + second, 0)
        if not len(sums) or sums.max() <= smallest:
            break
        best = int(sums.argmax())
        pair = [int(first[best]), int(second[best])]
        left[smallest] += 1
        left[pair[0]] -= 1
        left[pair[1]] -= 1
        bin_ = sorted([*bin_[:-1], *pair], reverse=True)
        gap = room - sum(pair)
    return bin_


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns of lengths and how often each is used; together they hold every piece once."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] = count
    out = []
    while left.any():
        before = left.copy()
        pattern = _fill(left, capacity)
        times = min(int(before[length]) // n for length, n in Counter(pattern).items())
        left = before
        for length in pattern:
            left[length] -= times
        out.append((pattern, times))
    return out


def _places(patterns: list[tuple[list[int], int]]) -> pd.DataFrame:
    """For each length, ranges of ranks: ``length, rank, sequence, offset`` at the start of a range."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "offset"]).astype("int64").sort_values(["length", "rank"], ignore_index=True)


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches):
        ranks: Counter = Counter()
        task, coder = TaskContext.get().partitionId(), encoder(path)
        for batch in batches:
            ids = batch.column(0)
            for start, _, texts in string_texts(batch.column(1)):
                owner, rows = [], []
                for i, tokens in enumerate(coder.encode(texts)):
                    tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                    # Whole sequences from the end; what is left over comes first.
                    cut = [0, *range(len(tokens) % capacity or capacity, len(tokens) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                        owner.append(start + i)
                        rows.append((piece, a, b - a, zlib.crc32(tokens[a:b].tobytes()), tokens[a:b] if with_ids else tokens[:0], task, ranks[b - a]))
                        ranks[b - a] += 1
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(owner, pa.int64())),
                        pa.array(columns[0], pa.int32()),
                        *(pa.array(c, pa.int64()) for c in columns[1:4]),
                        pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(x) for x in columns[4]]))).astype(np.int32), pa.array(np.concatenate(columns[4]).astype(np.int32))),
                        pa.array(columns[5], pa.int32()),
                        pa.array(columns[6], pa.int64()),
                    ],
                    names=["id", "piece", "start", "length", "crc32", "ids", "task", "place"],
                )

    return run


def pieces(
    documents: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Token pieces: ``id, piece, start, length, crc32, ids``, and the task and place among its pieces of one length.

    A text's ids by ``tokenizers`` and ``end_id``; a null text has that alone.
    Only lists over ``capacity`` are cut, into full pieces but for the first.
    ``ids`` is empty unless asked for.
    """
    schema = T.StructType(
        [
            T.StructField("id", documents.schema[id_column].dataType),
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(name, T.LongType()) for name in ("start", "length", "crc32")),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("task", T.IntegerType()),
            T.StructField("place", T.LongType()),
        ]
    )
    return documents.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(_pieces(path, capacity, end_id, with_ids), schema)


def _placed(places: pd.DataFrame, capacity: int):
    first = np.searchsorted(places["length"].to_numpy(), np.arange(capacity + 2))
    ranks, sequences, offsets = (places[c].to_numpy() for c in ("rank", "sequence", "offset"))

    def run(batches):
        for batch in batches:
            length, rank = np.array(batch.column("length")), np.array(batch.column("rank"))
            at = np.zeros(len(rank), dtype=np.int64)
            for own in np.unique(length).tolist():
                rows, a, b = length == own, first[own], first[own + 1]
                at[rows] = a + np.searchsorted(ranks[a:b], rank[rows], side="right") - 1
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])],
                names=[*(n for n in batch.schema.names if n != "rank"), "sequence_id", "offset"],
            )

    return run


def packed(
    documents: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """``id, piece, start, length, crc32, sequence_id, offset`` of each piece, and its ``ids`` if asked for.

    Pieces of a sequence follow each other without a gap from offset 0, and no
    sequence is over ``capacity``. Rows may repeat and ids may be null; each
    row's pieces are placed on their own. An empty table gives no rows.
    """
    cut = stage(pieces(documents, path, id_column, text, capacity, end_id, with_ids), "pieces")
    per_task = stage(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    # At most one row per length reaches the driver.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    columns = ["id", "piece", "start", "length", "crc32", *(["ids"] if with_ids else [])]
    ranked = cut.join(offsets, ["length", "task"]).select(*columns, (F.col("before") + F.col("place")).alias("rank"))
    schema = T.StructType([*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(_placed(places, capacity), schema)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, pieces, input_ids`` from :func:`packed` with ids: one row per sequence, bounded by its capacity.

    ``pieces`` says where each piece lies: ``offset, id, piece, start, length``.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "id", "piece", "start", "length", "ids")))
    own = F.transform("parts", lambda p: F.struct(p["offset"].alias("offset"), p["id"].alias("id"), p["piece"].alias("piece"), p["start"].alias("start"), p["length"].alias("length")))
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", own.alias("pieces"), ids.alias("input_ids"))
