"""Character trigrams of whole texts, counted and looked up as numbers inside tasks.

Three code points make one number of 63 bits. Texts come in lower case from
Spark and stay where they are; only counts and sums leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of text worked on at once; memory follows the slice and not the batch.
SLICE = 1 << 18
# Distinct trigrams a task holds before it hands their counts on (16 bytes each).
HELD = 2_000_000


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    binary = texts.cast(pa.binary())
    ends = np.cumsum(np.array(pc.fill_null(pc.binary_length(binary), 0), dtype=np.int64))
    start = 0
    while start < len(ends):
        limit = (ends[start - 1] if start else 0) + SLICE
        stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
        yield start, stop, [(x or b"").decode("utf-8", "replace") for x in binary.slice(start, stop - start).to_pylist()]
        start = stop


def _numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of all texts, one after the other, and how many each text has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    all_ = codes[:-2] << 21
    all_ += codes[1:-1]
    all_ <<= 21
    all_ += codes[2:]
    # Leave out those that reach into the next text: the last two places of each.
    inside = np.ones(len(codes), dtype=bool)
    ends = np.cumsum(sizes)
    inside[ends[sizes > 0] - 1] = False
    inside[ends[sizes > 1] - 2] = False
    return all_[inside[:-2]], np.maximum(sizes - 2, 0)


def _strings(numbers: np.ndarray) -> list[str]:
    codes = np.stack([numbers >> 42, (numbers >> 21) & 0x1FFFFF, numbers & 0x1FFFFF], axis=1).astype("<u4")
    joined = codes.tobytes().decode("utf-32-le", "surrogatepass")
    return [joined[i : i + 3] for i in range(0, len(joined), 3)]


def packed(trigrams: Sequence[str]) -> np.ndarray:
    """The numbers of trigrams."""
    return _numbers(list(trigrams))[0]


def _counts(numbers: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order and the sum of their counts."""
    if n is None:
        numbers = np.sort(numbers)
    else:
        order = np.argsort(numbers, kind="stable")
        numbers, n = numbers[order], n[order]
    edges = np.flatnonzero(np.diff(numbers, prepend=numbers[:1] - 1)) if len(numbers) else np.zeros(0, np.int64)
    sums = np.diff(np.append(edges, len(numbers))) if n is None else np.add.reduceat(n, edges) if len(edges) else n
    return numbers[edges], sums.astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(groups: list) -> tuple[np.ndarray, np.ndarray]:
        return groups[0] if len(groups) == 1 else _counts(np.concatenate([g for g, _ in groups]), np.concatenate([n for _, n in groups]))

    def out() -> Iterator[pa.RecordBatch]:
        for group, parts in held.items():
            grams, n = merged(parts)
            for at in range(0, len(grams), 100_000):
                some = _strings(grams[at : at + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array([group] * len(some), pa.string()), pa.array(some), pa.array(n[at : at + 100_000])], names=["by", "trigram", "n"])
        held.clear()

    for batch in batches:
        for start, stop, texts in _slices(batch.column(1)):
            groups: dict[str | None, list[str]] = {}
            for group, text in zip(batch.column(0).slice(start, stop - start).to_pylist(), texts, strict=True):
                groups.setdefault(group, []).append(text)
            for group, own in groups.items():
                parts = held.setdefault(group, [])
                parts.append(_counts(_numbers(own)[0]))
                if len(parts) > 16:
                    held[group] = [merged(parts)]
            if sum(len(g) for parts in held.values() for g, _ in parts) > HELD:
                yield from out()
    yield from out()


def counts(documents: DataFrame, text: str, by: str | None = None) -> DataFrame:
    """``by, trigram, n`` over the whole texts in lower case; ``by`` is null if none is named."""
    group = F.lit(None).cast("string") if by is None else F.col(by).cast("string")
    found = documents.select(group.alias("by"), F.lower(text).alias("text")).mapInArrow(_counted, "by string, trigram string, n long")
    return found.groupBy("by", "trigram").agg(F.sum("n").alias("n"))


def _summed(numbers: np.ndarray, values: np.ndarray, unseen: np.ndarray, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in _slices(batch.column(1)):
                grams, sizes = _numbers(texts)
                sums = np.zeros((len(texts), values.shape[1]))
                if len(grams):
                    place = np.minimum(np.searchsorted(numbers, grams), max(len(numbers) - 1, 0))
                    rows = values.take(place, axis=0) if len(numbers) else np.tile(unseen, (len(grams), 1))
                    if len(numbers):
                        rows[numbers.take(place) != grams] = unseen
                    filled = np.flatnonzero(sizes)
                    sums[filled] = np.add.reduceat(rows, (np.cumsum(sizes) - sizes)[filled], axis=0)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start).cast(kind), pa.array(sizes), flat], names=["key", "n", "sums"])

    return run


def sums(documents: DataFrame, key: str, text: str, numbers: np.ndarray, values: np.ndarray, unseen: Sequence[float]) -> DataFrame:
    """``key, n, sums``: per row how many trigrams its whole text has, and the sums of their ``values``.

    ``numbers`` are sorted; ``unseen`` is the row of values of all other trigrams.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = documents.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.DoubleType()))])
    narrow = documents.select(F.col(key).alias("key"), F.lower(text).alias("text"))
    return narrow.mapInArrow(_summed(numbers, values, np.array(unseen, dtype=np.float64), to_arrow_type(kind)), schema)


def means(documents: DataFrame, key: str, text: str, table: DataFrame, columns: Sequence[str], unseen: Sequence[float]) -> DataFrame:
    """``key, means``: per key the means of the table's ``columns`` over all trigrams of its whole texts, null without a trigram.

    The table (``trigram`` and ``columns``) is sent to every task: bound its size first.
    """
    known = table.select("trigram", *columns).toArrow()
    numbers = packed(known.column("trigram").to_pylist())
    values = np.stack([known.column(c).to_numpy() for c in columns], axis=1).reshape(len(numbers), len(columns))
    order = np.argsort(numbers)
    found = sums(documents, key, text, numbers[order], np.ascontiguousarray(values[order]), unseen)
    total = F.sum("n")
    averages = F.array(*[F.sum(F.get("sums", F.lit(i))) / total for i in range(len(columns))])
    return found.groupBy(F.col("key").alias(key)).agg(F.when(total > 0, averages).alias("means"))
