"""Exact duplicates through content-defined chunk recipes.

Texts are compared after deleting blanks. Each text is cut where a rolling hash
of the last 16 bytes says so, hence equal passages give equal chunks wherever
they stand. Distinct chunks travel once per task to be verified byte by byte;
a chunk's identifier is its fingerprint, plus a rank where different chunks
share a fingerprint. A text is then a short ordered list of identifiers, its
recipe, and texts are equal exactly when their recipes are. Only recipes, never
texts, take part in grouping and joining.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.llm.arrays import SpanHashes, byte_texts, joined_bytes
from annalist.llm.frames import stage, with_results

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 16
LEAST, MEAN, MOST = 256, 1024, 16384


def _spaced(cuts: list[int], size: int) -> list[int]:
    """Cut positions at least LEAST and at most MOST apart, the end included."""
    kept, last = [], 0
    for cut in [*cuts, size]:
        while cut - last > MOST:
            last += MOST
            kept.append(last)
        if cut == size:
            if size > last:
                kept.append(size)
        elif cut - last >= LEAST:
            kept.append(cut)
            last = cut
    return kept


def _chunks(texts: list[bytes], bits: int) -> Iterator[tuple[list[int], list[int]]]:
    """Chunk ends and fingerprints of each text without blanks."""
    codes, starts = joined_bytes(texts, b"")
    hashes = SpanHashes(codes)
    at = np.arange(WINDOW, len(codes) + 1) if len(codes) >= WINDOW else np.zeros(0, np.int64)
    found = at[hashes.get(at - WINDOW, at) % np.uint64(MEAN) == 0]
    bounds = np.searchsorted(found, starts)
    shift = np.uint64(64 - bits)
    for i in range(len(texts)):
        start, stop = int(starts[i]), int(starts[i + 1])
        # A window that reaches into the text before says nothing about this one.
        own = found[bounds[i] : np.searchsorted(found, stop)] - start
        ends = _spaced(own[(own >= WINDOW) & (own < stop - start)].tolist(), stop - start)
        if ends:
            to = np.array(ends) + start
            prints = hashes.get(np.concatenate(([start], to[:-1])), to) >> shift
            yield ends, prints.view(np.int64).tolist()
        else:
            yield [], []


#: Bytes that begin a character; deleting them leaves the continuing ones.
_FIRST_BYTES = bytes(b for b in range(256) if b & 0xC0 != 0x80)


def _recipes(bits: int, clashing: dict[tuple[int, bytes], int]):
    prints_that_clash = {p for p, _ in clashing}

    def identifiers(text: bytes, ends: list[int], prints: list[int]) -> list[int]:
        if not prints_that_clash.intersection(prints):
            return prints
        out = []
        for start, end, own in zip([0, *ends[:-1]], ends, prints, strict=True):
            out.append(own)
            if own in prints_that_clash:
                out.append(clashing[own, text[start:end]])
        return out

    def run(batches):
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for start, stop, texts in byte_texts(column):
                bare = [t.translate(None, BLANKS) for t in texts]
                points = [len(t) - len(t.translate(None, _FIRST_BYTES)) for t in texts]
                lists = [identifiers(t, *x) for t, x in zip(bare, _chunks(bare, bits), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, stop - start),
                        pa.array(points, pa.int64()),
                        pa.array([hashlib.sha256(b).hexdigest() for b in bare], pa.string()),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    names=["id", "points", "sha256", "recipe"],
                )

    return run


def _contents(bits: int):
    def run(batches):
        for batch in batches:
            for _, _, texts in byte_texts(batch.column(0)):
                bare = [t.translate(None, BLANKS) for t in texts]
                # Equal texts of a slice need their chunks read once.
                bare = list(dict.fromkeys(bare))
                prints, contents = [], []
                for text, (ends, own) in zip(bare, _chunks(bare, bits), strict=True):
                    prints += own
                    contents += [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints, pa.int64()), pa.array(contents, pa.binary())], names=["print", "content"]
                )

    return run


def clashing_chunks(documents: DataFrame, text: str = "text", bits: int = 64, most: int = 100_000) -> dict[tuple[int, bytes], int]:
    """Ranks of the different chunks that share a fingerprint: ``(print, content) -> rank``.

    Every distinct chunk is shuffled once per task and compared by its bytes, so
    an identifier stands for one content. With 64-bit fingerprints the result is
    empty up to billions of chunks; 10^11 distinct ones give some 300 rows. More
    than ``most`` mean that ``bits`` was set too low, which is an error.
    """
    distinct = documents.select(text).mapInArrow(_contents(bits), "print long, content binary").groupBy("print", "content").agg(F.lit(1).alias("one"))
    found = distinct.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} fingerprints stand for several chunks: use more bits")
    if not found:
        return {}
    clashes = distinct.where(F.col("print").isin([r["print"] for r in found])).select("print", "content").collect()
    ranks: dict[int, int] = {}
    out = {}
    for row in sorted(clashes):
        ranks[row["print"]] = rank = ranks.get(row["print"], -1) + 1
        out[row["print"], bytes(row["content"])] = rank
    return out


def recipes(documents: DataFrame, id_column: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """One row per row: ``id, points, sha256, recipe`` (code points; digest without blanks; verified identifiers)."""
    schema = T.StructType(
        [
            T.StructField("id", documents.schema[id_column].dataType),
            T.StructField("points", T.LongType()),
            T.StructField("sha256", T.StringType()),
            T.StructField("recipe", T.ArrayType(T.LongType())),
        ]
    )
    clashing = clashing_chunks(documents, text, bits)
    return documents.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(_recipes(bits, clashing), schema)


def duplicates(documents: DataFrame, id_column: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """One row per row of ``documents``: ``id, keep_id, group_size, kept, sha256, points``.

    Of texts equal without blanks, the one of most code points stays, then the
    smallest id (null ids last). A null text counts as empty, and all empty texts
    are equal. Of rows repeated with their id exactly one is kept. Other columns
    are not read, whatever their names.
    """
    # Repeated rows become one with a count, so copies collapse before each shuffle.
    rows = stage(
        recipes(documents, id_column, text, bits).groupBy("recipe", "sha256", "id", "points").agg(F.count("*").alias("copies")),
        "recipes",
    )
    order = F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("n"), F.col("id").alias("i"))
    groups = rows.groupBy("recipe").agg(F.sum("copies").alias("group_size"), F.min(order).alias("first"))
    # One row per group on the right; a group with many rows on the left is split by AQE.
    joined = rows.join(groups.withColumnRenamed("recipe", "of"), F.col("recipe") == F.col("of"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    stays = (F.col("points") == -F.col("first.p")) & F.col("id").eqNullSafe(F.col("first.i"))
    return joined.select("id", F.col("first.i").alias("keep_id"), "group_size", stays.alias("stays"), "sha256", "points", copy).select(
        "id", "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "sha256", "points"
    )


def without_duplicates(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows repeated with id and text one stays.

    Whole rows move once, those whose id is one of a dropped copy or repeated; all
    others stay in their task. Where repeated rows of one id and equally long texts
    differ in blanks or other columns, which of them stays is not defined.
    """
    results = T.StructType([T.StructField("_sha256", T.StringType()), T.StructField("_points", T.LongType())])
    found = duplicates(documents, id_column, text)
    name = F.coalesce(F.col("id").cast("string"), F.lit("null id")).alias("_of")
    # Ids all of whose rows stay need no second look.
    counts = found.groupBy(name).agg(F.count_if(~F.col("kept")).alias("lost"), F.count("*").alias("n"))
    odd = stage(counts.where((F.col("lost") > 0) | (F.col("n") > 1)).select("_of", (F.col("lost") == F.col("n")).alias("_none")), "dropped-ids")
    kept = found.where("kept").select(name, "sha256", "points")
    own = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("null id"))
    rows = documents.select(F.struct("*").alias("row"), own.alias("_own"))
    whole = rows.join(odd, rows["_own"] == odd["_of"], "left_anti").select("row.*")
    partly = odd.where(~F.col("_none"))
    some = rows.join(partly, rows["_own"] == partly["_of"], "left_semi").select("row.*")
    marked = with_results(some, text, results, None, _identities)
    marked = marked.select("row", "_sha256", "_points", F.coalesce(F.col("row")[id_column].cast("string"), F.lit("null id")).alias("_own"))
    same = (F.col("_own") == F.col("_of")) & (F.col("_sha256") == F.col("sha256")) & (F.col("_points") == F.col("points"))
    stays = marked.join(kept, same, "left_semi").dropDuplicates(["_own", "_sha256", "_points"]).select("row.*")
    return whole.unionAll(stays)


def _identities(texts: list[str], _) -> list:
    """Digest without blanks, and code points, of each text."""
    return [[hashlib.sha256(t.encode().translate(None, BLANKS)).hexdigest() for t in texts], [len(t) for t in texts]]
