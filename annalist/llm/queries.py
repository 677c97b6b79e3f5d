"""The registered queries of this package; the SQL is in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm import alignment, chat, corpus_flags, exact_dedup, jaccard_join, language_id, line_dedup, line_quality, packing, periodic_runs, piece_sampling, quality_rules, sharding, toxicity
from annalist.llm.frames import id_hash, let, table
from annalist.llm.oracles import SQL

__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


QUERIES["corpus_flags"] = corpus_flags.run


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, folder, "labels"))
    found = toxicity.score(documents, model).select(F.col("row.doc_id").alias("doc_id"), "score", F.size("offending").cast("long").alias("n_offending"))
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_offending")


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.judged(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.arrays_overlap("failed", F.array(*map(F.lit, quality_rules.BASE)))
    counts = [F.col(f"measures.{name}") for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts, base.alias("base_failed"), "kept")


@query
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join.similar(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "copy_id", "n_links")


@query
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    placed = packing.packed(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc32").alias("ids_crc32"), "sequence_id", "offset")


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    models = language_id.fit(documents)
    found = language_id.predicted(documents.select("doc_id", "text"), models)
    return found.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score", "rejected").select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    written = sharding.write_shards(documents.select("doc_id", "text"), sharding.shard_folder(documents))
    text = F.coalesce("row.text", F.lit("")).cast("binary")
    return written.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    planted = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = given.union(planted)
    formatted = chat.rendered(chat.folded(chat.as_events(rows)))
    read = chat.read_back(formatted)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.without_boilerplate(table(spark, folder, "pages"))
    return found.select(
        F.col("row.page_id").alias("page_id"),
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("kept_text"),
    )


@query
def op2_piece_sampling(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_sampling.encoded(table(spark, folder, "documents").select("doc_id", "text"), path)
    found = piece_sampling.decoded(encoded, F.col("ids"), path)
    text = F.coalesce("row.row.text", F.lit(""))
    return found.select(
        F.col("row.row.doc_id").alias("doc_id"),
        F.size("row.ids").cast("long").alias("n_pieces"),
        F.xxhash64("row.ids").alias("ids_hash"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("text") == text).alias("lossless"),
    )


def with_repeats(documents: DataFrame) -> DataFrame:
    """The documents, a tenth of them with a passage that repeats itself up to the end, as the contract of op11 plants them."""
    text = F.coalesce("text", F.lit(""))
    h = id_hash("doc_id")
    g = F.floor(h / 10)

    def planted(words):
        n = F.size(words)
        start = (g % n).cast("int")
        period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
        again = F.ceil((n - start) / period).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, start + 1, period), again))
        return F.when(n > 0, F.array_join(F.slice(F.concat(F.slice(words, 1, start), tail), 1, n), " ")).otherwise(text)

    split = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    return documents.select("doc_id", F.when(h % 10 == 0, let(split, planted)).otherwise(text).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_repeats(table(spark, folder, "documents")))
    # Runs come by start and period, so of equals the first one stays.
    better = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    nothing = F.lit(None).cast(periodic_runs.RUN)
    best = F.aggregate("runs", nothing, lambda best, run: F.when(better(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    names = ["n_a", "n_b", "n_groups", "n_overlaps", "links", "groups"]
    found = alignment.aligned(table(spark, folder, "documents").select("doc_id", "text"), *paths, names)
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = found.select(F.col("row.doc_id").alias("doc_id"), *names[:4], "links", digest.alias("groups_sha256"))
    return alignment.scored(rows, *paths).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"
    )


@query
def op13_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = line_quality.fit(documents, table(spark, folder, "labels"))
    bad = F.filter("lines", lambda line: line["good"] < 0.5)
    found = line_quality.score(documents, model).select(F.col("row.doc_id").alias("doc_id"), "score", F.size(bad).cast("long").alias("n_bad_lines"))
    return found.select("doc_id", line_quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_bad_lines")
