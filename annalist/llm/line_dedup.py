"""Line dedup by site-relative frequency.

A line is boilerplate of a site if more than a given share of the site's pages
hold it, and at least three pages do. That floor departs from the share alone:
hosts of one or two pages keep all their lines, also one that stands on both
pages, and on hosts of three to six pages a line on two of them stays. Pages are counted per (host, line) with each page's distinct lines, so
partial sums carry a frequent line as one row per task, and a big host spreads
over its lines. Only the boilerplate lines travel back to the pages that hold
them. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.frames import stage

#: A line on more than this share of a host's pages is boilerplate ...
RATIO = 0.3
#: ... if it is on at least this many: on a host of one page every line is on all pages.
LEAST_PAGES = 3

#: Elements without text, elements that begin a line, and entities.
HIDDEN = r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
BLOCKS = "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
BLOCK = rf"(?i)</?(?:{'|'.join(BLOCKS)})(?:[ \t\r\n\f][^>]*)?/?>"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}
BLANKS = " \t\r\f\x0b"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty for a null or odd one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def html_lines(html: Column) -> Column:
    """The lines of a page as its blocks show them: trimmed, none empty; none for null."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), r"<[^>]*>", "")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.array_remove(F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS))), "")


def _digests(lines: Column) -> Column:
    """128 bits of each line."""
    return F.transform(lines, lambda line: F.unhex(F.md5(line.cast("binary"))))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host, line`` (a digest) ``, pages, share`` of the lines that are boilerplate of their host.

    ``pages`` has ``host`` and ``digests``, those of its lines; every row counts
    as a page.
    """
    each = pages.select("host", F.explode(F.array_distinct("digests")).alias("line"))
    often = each.groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    share = F.col("pages") / F.col("total")
    return often.join(totals, "host").select("host", "line", "pages", share.alias("share")).where(F.col("share") > ratio)


def without_boilerplate(
    pages: DataFrame, url: str = "url", html: str = "html", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """One row per row: ``row`` (all columns as they came but ``html``), ``host, lines, kept``.

    ``lines`` are the page's lines and ``kept`` those that are no boilerplate of
    its host, in order, repeats included. A page without lines keeps none; pages
    without a host form one site. Ids may be null or repeated.

    Pages are parsed once: their lines and digests are written to shared storage,
    and lines, not pages, move to meet what is to drop.
    """
    rest = [F.col(f"`{c}`") for c in pages.columns if c != html]
    parsed = pages.select(F.struct(*rest).alias("row"), host_of(F.col(f"`{url}`")).alias("host"), html_lines(F.col(f"`{html}`")).alias("lines"))
    # Ids may repeat, so each row gets a number of its own, lasting as it is written.
    staged = stage(parsed.select("*", _digests(F.col("lines")).alias("digests"), F.monotonically_increasing_id().alias("key")), "page-lines")
    found = boilerplate(staged, ratio, least_pages)
    each = staged.select("key", "host", F.explode(F.array_distinct("digests")).alias("line"))
    # Only lines to drop come back; a list is no longer than its page.
    drops = each.join(found.select("host", "line"), ["host", "line"]).groupBy("key").agg(F.collect_set("line").alias("drops"))
    rows = staged.join(drops, "key", "left")
    kept = F.filter("lines", lambda line, i: ~F.array_contains(F.col("drops"), F.get("digests", i)))
    return rows.select("row", "host", "lines", F.when(F.col("drops").isNull(), F.col("lines")).otherwise(kept).alias("kept"))
