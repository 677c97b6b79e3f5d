"""Similarity self-join on word n-grams by chosen paths.

Texts become sets of hashed five-word shingles. Each set picks the few of its
tokens whose seeded hash is below ``picks / size``; similar sets pick common
tokens, and sets that share a pick meet in its bucket. A bucket too large to
compare is split again by fresh picks, level by level, so unrelated texts that
share one frequent passage part; a bucket whose members stay together whatever
is picked is a group of near copies and is compared in blocks. What is large
after all levels is cut by set size, as similar sets are of similar size, and
compared in blocks. Small buckets are
brute-forced, and independent runs repeat until a pair at the threshold is met
with the target probability. Every pair that meets is verified exactly.

Equal sets are one class from the start. Pairs are not written out: a bucket
yields for each member how many links it has and a spanning tree of them. A pair
that meets in several buckets counts in the least of these only, which both
members know from their bucket lists.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.llm.arrays import PrimeHashes, byte_texts, joined_bytes, mix, runs, slices, sorted_set
from annalist.llm.components import components
from annalist.llm.frames import stage, with_results

WORDS = 5
THRESHOLD = 0.8
#: Expected picks of a set at each level of splitting.
PICKS = (4.0, 5.0, 5.0)
TARGET_RECALL = 0.9999
#: Most sets compared with each other in one piece; larger buckets are split or cut into blocks.
BUCKET = 600
#: A bucket whose large children hold this many times its members does not split: near copies.
DENSE = 1.5
#: Most members of a bucket that a task splits by itself (some 300 bytes each).
IN_TASK = 100_000
BINS = 128
#: Bytes of text hashed at once; two polynomials over them hold some 200 bytes for each.
SLICE = 1 << 18


def needed_runs(threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> int:
    """Runs after which a pair at the threshold, split at every level, was missed with at most ``1 - target``.

    The smaller of two sets shares at least ``threshold`` of the larger one's
    size, so each level has that share of its picks in common on average.
    """
    miss = 1 - math.prod(1 - math.exp(-p * threshold) for p in PICKS)
    return max(1, math.ceil(math.log(1 - target) / math.log(miss)))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    codes, starts = joined_bytes(texts)
    start, end = runs(~((codes == 32) | ((codes >= 9) & (codes <= 13))))
    of_words = PrimeHashes(codes).get(start, end)
    chain = PrimeHashes(of_words, seed=words)
    bounds = np.searchsorted(start, starts)
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        size = min(words, last - first)
        at = np.arange(first, last - size + 1) if size else np.zeros(0, np.int64)
        yield sorted_set(chain.get(at, at + size))


def set_key(tokens: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    return tokens.sum(dtype=np.uint64).tobytes() + mix(tokens + np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64).tobytes()


def _sketch(tokens: np.ndarray) -> bytes:
    """One byte of the least token in each of BINS ranges; 0 where a range is empty."""
    edges = np.searchsorted(tokens, np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1))
    ends = np.append(edges[1:], len(tokens))
    out = np.zeros(BINS, dtype=np.uint8)
    full = edges < ends
    out[full] = tokens[edges[full]] % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def _picked(tokens: np.ndarray, run: int, level: int) -> list[int]:
    seeded = mix(tokens ^ np.uint64((run * 31 + level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    share = PICKS[level] / len(tokens)
    chosen = seeded if share >= 1 else seeded[seeded < np.uint64(int(share * 2**64))]
    return chosen.view(np.int64).tolist()


def _features(repeats: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for start, stop, texts in byte_texts(batch.column(1), SLICE):
                rows = []
                for tokens in shingle_sets(texts):
                    paths = [[_picked(tokens, r, level) if len(tokens) else [] for r in range(repeats)] for level in range(len(PICKS))]
                    rows.append((set_key(tokens), len(tokens), _sketch(tokens), paths))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, stop - start),
                        pa.array([r[0] for r in rows], pa.binary()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.binary()),
                        pa.array([r[3] for r in rows], pa.list_(pa.list_(pa.list_(pa.int64())))),
                    ],
                    names=["id", "k", "size", "sketch", "paths"],
                )

    return run


def _met(rows: DataFrame) -> DataFrame:
    """Members of buckets that have company: ``bucket, run, k, members``."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    return stage(rows.join(sizes, "bucket"), "buckets")


def _window(threshold: float) -> float:
    """Width, in logarithms, of windows such that similar sizes lie in the same or in neighbouring ones."""
    return -math.log(threshold) * (1 + 1e-6)


def _split(bucket: int, threshold: float):
    """Split one bucket, level by level, into buckets that are compared: ``leaf, k, members``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, sizes, picks = pdf["k"].to_numpy(), pdf["size"].to_numpy(), pdf["deeper"].tolist()
        found: list[tuple[int, np.ndarray]] = []
        todo = [(int(pdf["bucket"].iloc[0]) % 2**64, np.arange(len(pdf)), 0)]
        while todo:
            name, members, level = todo.pop()
            if len(members) <= bucket:
                found.append((name, members))
                continue
            if level == len(picks[0]):
                # Each set is in two neighbouring windows, so sets of similar size share one.
                windows = np.floor(np.log(sizes[members]) / _window(threshold)).astype(np.int64)
                for window in range(int(windows.min()), int(windows.max()) + 2):
                    own = members[(windows == window) | (windows == window - 1)]
                    if len(own) > 1:
                        found.append((_child(name, window), own))
                continue
            lists = [picks[i][level] for i in members]
            owner = np.repeat(members, [len(x) for x in lists])
            token = np.array([t for x in lists for t in x], dtype=np.int64)
            order = np.argsort(token, kind="stable")
            owner, token = owner[order], token[order]
            edges = np.flatnonzero(np.diff(token) != 0) + 1
            children = [(int(token[a]), owner[a:b]) for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(token)], strict=True) if b - a > 1]
            if sum(len(m) for _, m in children if 2 * len(m) > len(members)) >= DENSE * len(members):
                # Near copies: they stay together whatever is picked.
                found.append((name, members))
                continue
            todo += [(_child(name, t), m, level + 1) for t, m in children]
        leaves = np.repeat(np.array([name for name, _ in found], dtype=np.uint64).view(np.int64), [len(m) for _, m in found])
        members = np.concatenate([m for _, m in found]) if found else np.zeros(0, np.int64)
        counts = np.repeat(np.array([len(m) for _, m in found], dtype=np.int64), [len(m) for _, m in found])
        return pd.DataFrame({"leaf": leaves, "k": keys[members], "members": counts})

    return run


def _child(name: int, token: int) -> int:
    return int(mix(np.array([(name * 0x9E3779B97F4A7C15 + token) % 2**64], dtype=np.uint64))[0])


def _leaves(classes: DataFrame, bucket: int, threshold: float, whole: int = IN_TASK) -> DataFrame:
    """``leaf, k, members``: each bucket that is compared, with its members.

    Buckets of up to ``whole`` members are split inside a task; larger ones are
    first split by a shuffle per level until they fit or no level is left.
    """
    picks = classes.select("k", F.posexplode(F.col("paths")[0]).alias("run", "tokens")).select("k", "run", F.explode("tokens").alias("token"))
    level = _met(picks.select("k", "run", F.xxhash64("run", "token").alias("bucket")))
    members, named = F.col("members"), [F.col("bucket").alias("leaf"), "k", "members"]
    parts = [level.where(members <= bucket).select(*named)]
    for depth in range(1, len(PICKS)):
        fits = level.where((members > bucket) & (members <= whole)).join(classes.select("k", "size", "paths"), "k")
        deeper = F.transform(F.slice("paths", depth + 1, len(PICKS) - depth), lambda p: F.get(p, F.col("run")))
        split = fits.select("bucket", "k", "size", deeper.alias("deeper")).groupBy("bucket")
        parts.append(split.applyInPandas(_split(bucket, threshold), "leaf long, k binary, members long"))
        level = level.where(members > whole)
        if level.isEmpty():
            break
        again = level.join(classes.select("k", F.col("paths")[depth].alias("tokens")), "k")
        again = again.select("k", "run", F.col("bucket").alias("parent"), members.alias("of"), F.explode(F.get("tokens", F.col("run"))).alias("token"))
        child = _met(again.select("k", "run", "parent", "of", F.xxhash64("parent", "token").alias("bucket")))
        # Members that meet again in large children, over the members there were.
        kept = F.sum(F.when(members * 2 > F.col("of"), 1).otherwise(0)) / F.first("of")
        dense = stage(child.groupBy("parent").agg(kept.alias("kept")).where(F.col("kept") >= DENSE).select("parent"), "dense")
        parts.append(level.join(dense.withColumnRenamed("parent", "bucket"), "bucket", "left_semi").select(*named))
        level = child.join(dense, "parent", "left_anti")
        parts.append(level.where(members <= bucket).select(*named))
    else:
        # Beyond all levels: what is still large is cut into windows of size.
        first = F.floor(F.log("size") / F.lit(_window(threshold)))
        rest = level.where(members > bucket).join(classes.select("k", "size"), "k")
        rest = rest.select("k", "run", "bucket", F.explode(F.array(first, first + 1)).alias("window"))
        parts.append(_met(rest.select("k", "run", F.xxhash64("bucket", "window").alias("bucket"))).select(*named))
    leaves = stage(reduce(DataFrame.union, parts), "leaves")
    # Runs meet the same groups again: of buckets with equal members one is enough.
    sums = [F.sum(F.xxhash64(F.lit(i), "k").cast("decimal(38,0)")).alias(name) for i, name in enumerate(("sum", "other"))]
    sums = leaves.groupBy("leaf").agg(*sums, F.count("*").alias("n"))
    chosen = sums.groupBy("sum", "n", "other").agg(F.min("leaf").alias("leaf")).select("leaf")
    return leaves.join(chosen, "leaf")


def _units(leaves: DataFrame, bucket: int) -> DataFrame:
    """``leaf, low, high, block``: leaves over the limit are compared block by block."""
    blocks = F.ceil(F.col("members") / F.lit(bucket)).cast("int")
    block = F.pmod(F.xxhash64("k"), blocks.cast("long")).cast("int")
    rows = leaves.select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return rows.select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).drop("other", "members")


def _binned(units: DataFrame, rows: int) -> DataFrame:
    """Whole units in groups of about ``rows`` rows."""
    return units.withColumn("bin", F.pmod(F.xxhash64("leaf", "low", "high"), F.lit(max(1, units.count() // rows)).cast("long")))


def _unit_ranges(pdf: pd.DataFrame) -> list[tuple[int, int]]:
    keys = pdf[["leaf", "low", "high"]].to_numpy()
    edges = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
    return list(zip([0, *edges.tolist()], [*edges.tolist(), len(pdf)], strict=True))


def _owned(own: list, others: list, leaf: int) -> np.ndarray:
    """Which of ``others`` meet ``own`` in no bucket before ``leaf``."""
    before = {x for x in own if x < leaf}
    if not before:
        return np.ones(len(others), dtype=bool)
    return np.fromiter((before.isdisjoint(x) for x in others), bool, len(others))


def _candidates(threshold: float):
    """Members of a unit that some other member of it may be similar to."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["leaf", "low", "high"], ignore_index=True)
        sketches = np.frombuffer(b"".join(pdf["sketch"]), dtype=np.uint8).reshape(len(pdf), BINS)
        sizes, blocks, lists = pdf["size"].to_numpy(), pdf["block"].to_numpy(), pdf["leaves"].tolist()
        leaf, crossing = pdf["leaf"].tolist(), (pdf["low"] != pdf["high"]).to_numpy()
        active = np.zeros(len(pdf), dtype=bool)
        for start, stop in _unit_ranges(pdf):
            for i in range(start, stop - 1):
                rest = slice(i + 1, stop)
                fits = np.minimum(sizes[rest], sizes[i]) >= threshold * np.maximum(sizes[rest], sizes[i])
                if crossing[i]:
                    fits &= blocks[rest] != blocks[i]
                at = np.flatnonzero(fits) + i + 1
                if not len(at):
                    continue
                own, others = sketches[i], sketches[at]
                equal = ((others == own) & (own != 0)).sum(axis=1)
                seen = ((others | own) != 0).sum(axis=1)
                # Five standard deviations below what the threshold leads one to expect.
                near = at[equal >= threshold * seen - 5 * np.sqrt(threshold * (1 - threshold) * seen)]
                if len(near):
                    near = near[_owned(lists[i], [lists[j] for j in near.tolist()], leaf[i])]
                    if len(near):
                        active[i] = True
                        active[near] = True
        return pdf.loc[active, ["leaf", "low", "high", "block", "k"]]

    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of up to two blocks of sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.cumsum(often > 1) - 1
    shared = often[place] > 1
    owner, column = owner[shared], order[place[shared]]
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    total = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = 4096
    for first in range(0, int(order[-1]) + 1 if len(order) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        total += part @ part.T
    return total


def _verified(threshold: float):
    """Per unit and member: links to others (copies of these counted) and the root of its tree of links."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["leaf", "low", "high"], ignore_index=True)
        keys, blocks, lists = pdf["k"].tolist(), pdf["block"].to_numpy(), pdf["leaves"].tolist()
        copies, leaf, crossing = pdf["copies"].to_numpy(), pdf["leaf"].tolist(), (pdf["low"] != pdf["high"]).to_numpy()
        out = []
        for start, stop in _unit_ranges(pdf):
            texts = [t or b"" for t in pdf["text"].iloc[start:stop]]
            parts = slices(np.array([len(t) for t in texts], dtype=np.int64), SLICE)
            sets = [s for first, last in parts for s in shingle_sets(texts[first:last])]
            sizes = np.array([len(s) for s in sets])
            if stop - start == 2:
                overlap = np.zeros((2, 2))
                overlap[0, 1] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
            else:
                overlap = _overlaps(sets)
            similar = overlap >= threshold * (sizes[:, None] + sizes[None, :] - overlap) - 1e-9
            if crossing[start]:
                own = blocks[start:stop]
                similar &= own[:, None] != own[None, :]
            root = list(range(stop - start))

            def find(x: int, root: list[int] = root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            links = np.zeros(stop - start, dtype=np.int64)
            for i in range(stop - start - 1):
                near = np.flatnonzero(similar[i, i + 1 :]) + i + 1
                if len(near):
                    near = near[_owned(lists[start + i], [lists[start + j] for j in near.tolist()], leaf[start])]
                links[i] += copies[start + near].sum()
                links[near] += copies[start + i]
                for j in near.tolist():
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
            out += [(keys[start + i], keys[start + find(i)], int(links[i])) for i in np.flatnonzero(links).tolist()]
        return pd.DataFrame(out, columns=["k", "root", "links"])

    return run


def similar(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, bucket: int = BUCKET, whole: int = IN_TASK
) -> DataFrame:
    """One row per row of ``documents``: ``id, k, class_id, copy_id, n_links``.

    ``n_links`` counts the other rows whose shingle sets have a Jaccard
    similarity of at least ``threshold``, equal sets included; ``class_id`` is
    the least id of all rows that links connect; ``copy_id`` the least id with an
    equal set; ``k`` identifies the set. Null texts, and texts without a word,
    have no links and are classes of their own. Null ids sort after all others.
    Nothing is cut off: every bucket is compared, whatever its size.
    """
    schema = T.StructType(
        [
            T.StructField("id", documents.schema[id_column].dataType),
            T.StructField("k", T.BinaryType()),
            T.StructField("size", T.LongType()),
            T.StructField("sketch", T.BinaryType()),
            T.StructField("paths", T.ArrayType(T.ArrayType(T.ArrayType(T.LongType())))),
        ]
    )
    own = documents.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    features = stage(own.mapInArrow(_features(needed_runs(threshold)), schema), "shingles")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "sketch", "paths"))
    classes = features.where("size > 0").groupBy("k", "size").agg(first.alias("f"), F.count("*").alias("copies"))
    classes = stage(classes.select("k", "size", "copies", F.col("f.id").alias("id"), F.col("f.sketch").alias("sketch"), F.col("f.paths").alias("paths")), "classes")

    leaves = stage(_leaves(classes, bucket, threshold, whole), "leaves")
    lists = stage(leaves.groupBy("k").agg(F.sort_array(F.collect_list("leaf")).alias("leaves")), "lists")
    known = classes.select("k", "size", "sketch").join(lists, "k")
    units = stage(_units(leaves.join(known, "k"), bucket), "units")
    active = _binned(units, 2000).groupBy("bin").applyInPandas(_candidates(threshold), "leaf long, low int, high int, block int, k binary")
    active = stage(active, "active")

    # Texts of the classes that may have a partner, once each; an id may stand for several texts.
    wanted = active.select("k").distinct().join(classes.select("k", "id", "copies"), "k")
    found = own.join(wanted, own["id"].eqNullSafe(wanted["id"])).select("k", "copies", F.col("text").cast("binary").alias("text"))
    found = found.mapInArrow(_of_key, found.schema).dropDuplicates(["k"]).join(lists, "k")
    pairs = _binned(active, 400).join(found, "k").groupBy("bin").applyInPandas(_verified(threshold), "k binary, root binary, links long")
    pairs = stage(pairs, "links")

    tied = components(pairs.select(F.col("k").alias("a"), F.col("root").alias("b")))
    links = pairs.groupBy("k").agg(F.sum("links").alias("links"))
    labelled = classes.select("k", "id", "copies").join(links, "k", "left").join(tied.select(F.col("a").alias("k"), F.col("b").alias("label")), "k", "left")
    labelled = stage(labelled.withColumn("label", F.coalesce("label", "k")), "labels")
    least = labelled.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("least"))
    of_class = labelled.join(least, "label").select(
        "k", F.col("id").alias("copy_id"), F.col("least.id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    joined = features.select("id", "k", "size").join(of_class, "k", "left")
    alone = F.col("size") == 0
    return joined.select(
        "id",
        "k",
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )


def _of_key(batches):
    """Rows whose text has the wanted set."""
    for batch in batches:
        wanted = batch.column(0).to_pylist()
        for start, stop, texts in byte_texts(batch.column(2), SLICE):
            keep = [set_key(tokens) == wanted[start + i] for i, tokens in enumerate(shingle_sets(texts))]
            yield batch.slice(start, stop - start).filter(pa.array(keep, pa.bool_()))


def _keys(texts: list[str], _) -> list:
    sets = list(shingle_sets([t.encode("utf-8", "surrogatepass") for t in texts]))
    return [[set_key(s) for s in sets], [len(s) for s in sets]]


def without_similar(documents: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of each group that links connect, that of the least id, with all its columns.

    Rows without a word are groups of their own; of rows repeated with id and
    set one stays.
    """
    found = similar(documents, id_column, text, threshold)
    kept = found.where(F.col("id").eqNullSafe(F.col("class_id"))).select(F.coalesce(F.col("id").cast("string"), F.lit("null id")).alias("_id"), "k").distinct()
    results = T.StructType([T.StructField("_k", T.BinaryType()), T.StructField("_size", T.LongType())])
    rows = with_results(documents, text, results, None, _keys, SLICE)
    rows = rows.select("row", "_k", "_size", F.coalesce(F.col("row")[id_column].cast("string"), F.lit("null id")).alias("_own"))
    stays = rows.join(kept, (rows["_own"] == kept["_id"]) & (rows["_k"] == kept["k"]), "left_semi")
    return stays.dropDuplicates(["_own", "_k"]).select("row.*")
