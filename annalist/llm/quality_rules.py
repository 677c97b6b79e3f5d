"""Quality rules: a table of limits compiled into one projection.

Every measure of a text comes from one expression of built-in functions, and the
table of limits becomes one more expression over those measures. There is no
shuffle and no user function; each row is judged where it was read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.frames import let

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Frequent function words of the languages served.
STOP_WORDS = (
    "a and are as at be but by for from has have he in is it its of on or she that the their they this to was were which with "
    "au aux avec ce ces dans de des du elle en est et il ils la le les leur ne pas par plus pour que qui se sont sur un une "
    "als an auch auf aus bei das dem den der des die ein eine einen er es für hat im ist mit nach nicht oder sich sie und von wie zu zum "
    "al como con del el ella en entre era es esta este la las lo los más no o para pero por que se sin su sus un una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= measure / per <= most``; a bound that is None does not apply."""

    name: str
    measure: str
    per: str | None
    least: float | None
    most: float | None


#: The limits. A text passes if all hold; ratios of nothing count as 0.
RULES = (
    Rule("words", "n_words", None, 50, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.5),
    Rule("word_length", "word_chars", "n_words", 2, 25),
    Rule("symbols", "n_symbols", "n_words", None, 0.25),
    Rule("stop_words", "n_stop_words", "n_words", 0.005, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.4),
    Rule("lines", "n_lines", "n_words", None, 0.5),
)
#: The rules every caller shares; the others are this method's verdict.
BASE = ("words", "repeated_words")


def _repeated(hashes: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(sorted_pairs: Column) -> Column:
            def found(p, i):
                same = (F.get(sorted_pairs, i - 1)["h"] == p["h"]) | (F.get(sorted_pairs, i + 1)["h"] == p["h"])
                return F.coalesce(same, F.get(sorted_pairs, i - 1)["h"] == p["h"], F.get(sorted_pairs, i + 1)["h"] == p["h"], F.lit(False))

            places = F.sort_array(F.transform(F.filter(sorted_pairs, found), lambda p: p["i"]))
            start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
            # A window adds the words that the one before did not cover.
            return F.aggregate(
                places, start, lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")), lambda s: s["n"]
            )

        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(pairs, count)).otherwise(F.lit(0).cast("long"))

    windows = F.slice(
        F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2))), F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0))
    )
    return let(windows, covered)


def measures(text: Column) -> Column:
    """A struct of counts over the whole text; null reads as empty.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words,
    n_stop_words``. Words are runs without ASCII blanks; lines are split at ``\\n``
    and count if they hold a word. Windows are compared by 64-bit hashes.
    """

    def count(value: Column) -> Column:
        return value.cast("long")

    def of_words(whole: Column, words: Column) -> Column:
        lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return let(
            lines,
            lambda kept: F.struct(
                count(F.size(words)).alias("n_words"),
                count(F.length(F.array_join(words, ""))).alias("word_chars"),
                count(F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS + "+", ""))).alias("n_symbols"),
                count(F.size(kept) - F.size(F.array_distinct(kept))).alias("n_dup_lines"),
                count(F.size(kept)).alias("n_lines"),
                let(F.transform(words, lambda w: F.xxhash64(w)), _repeated).alias("n_repeat_words"),
                count(F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS)))).alias("n_stop_words"),
            ),
        )

    whole = F.coalesce(text, F.lit(""))
    return let(whole, lambda t: let(F.array_remove(F.split(t, BLANK + "+"), ""), lambda words: of_words(t, words)))


def passes(found: Column, rule: Rule) -> Column:
    """Whether measured counts keep one rule."""
    value = found[rule.measure].cast("double")
    if rule.per:
        value = F.when(found[rule.per] == 0, 0.0).otherwise(value / found[rule.per])
    bounds = [value >= rule.least] if rule.least is not None else []
    bounds += [value <= rule.most] if rule.most is not None else []
    return reduce(Column.__and__, bounds, F.lit(True))


def verdict(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    return reduce(Column.__and__, [passes(found, rule) for rule in rules], F.lit(True))


def judged(documents: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row, measures, failed, kept``: the columns as they came, the counts, the names of broken rules.

    Null and empty texts have no word and are not kept. Every row gives a row, in
    place; columns of any name ride along in the struct.
    """
    found = documents.select(F.struct("*").alias("row"), measures(F.col(text)).alias("measures"))
    failed = F.array_compact(F.array(*[F.when(~passes(F.col("measures"), rule), F.lit(rule.name)) for rule in rules]))
    return found.select("row", "measures", failed.alias("failed")).select("*", (F.size("failed") == 0).alias("kept"))


def without_low_quality(documents: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that keep every rule, unchanged."""
    return documents.where(let(measures(F.col(text)), lambda found: verdict(found, rules)))
