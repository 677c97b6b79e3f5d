"""Text cleaning, measures, headers and the legacy Cyrillic encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four control separators.
BLANKS_IN_LINE = (
    "\t\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANKS = BLANKS_IN_LINE + "\n"


def strip_text(text: Column) -> Column:
    """Both ends stripped of any Unicode blank."""
    return F.trim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    """True for null, empty or blank-only text."""
    return F.coalesce(strip_text(text) == "", F.lit(True))


def clean_text(text: Column) -> Column:
    """Right-strip lines, keep one blank line at most, strip the ends, end with a newline.

    Trimming works on the bytes in place, several times faster than regular
    expressions on the decoded text, which remain for long blank gaps only.
    """
    lines = F.transform(F.split(text, "\n"), lambda line: F.rtrim(line, F.lit(BLANKS_IN_LINE)))
    joined = F.array_join(lines, "\n")
    squeezed = F.when(joined.contains("\n\n\n"), F.regexp_replace(joined, r"\n{3,}", "\n\n")).otherwise(joined)
    return F.concat(strip_text(squeezed), F.lit("\n"))


def text_length(text: Column) -> Column:
    """Code points of the text; 0 for null."""
    return F.coalesce(F.length(text), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of blank-separated words; 0 for null."""
    words = F.regexp_count(text, F.lit(r"(?U)[^\s\x1c-\x1f]++"))
    return F.coalesce(words, F.lit(0))


def quote(value: Column, escape: bool = True) -> Column:
    """Double-quoted header value; ``escape=False`` leaves inner quotes as they are."""
    value = F.coalesce(value, F.lit(""))
    if escape:
        for raw, safe in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
            value = F.replace(value, F.lit(raw), F.lit(safe))
    return F.concat(F.lit('"'), value, F.lit('"'))


def unquote(value: Column) -> Column:
    """Inverse of :func:`quote`."""
    inner = F.regexp_extract(value, r'(?s)^"(.*)"$', 1)
    # Protect escaped backslashes first, so "\\n" is not read as a newline.
    inner = F.replace(inner, F.lit("\\\\"), F.lit("\x00"))
    inner = F.replace(F.replace(inner, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))
    return F.replace(inner, F.lit("\x00"), F.lit("\\"))


def header(
    source: Column,
    dokid: Column,
    nreg: Column,
    title: Column,
    doc_date: Column,
    revision_date: Column,
    status: Column,
    types: Column,
    org: Column,
    escape: bool = True,
) -> Column:
    """Metadata header; lines whose value is missing are left out."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    type_list = F.when(
        F.size(types) > 0, F.concat(F.lit("["), F.array_join(types.cast("array<string>"), ", "), F.lit("]"))
    )
    return F.concat(
        F.concat_ws(
            "\n",
            F.lit("---"),
            line("source", quote(source, escape)),
            line("dokid", dokid.cast("string")),
            line("nreg", quote(nreg, escape)),
            line("title", quote(title, escape)),
            line("doc_date", doc_date.cast("string")),
            line("revision_date", revision_date.cast("string")),
            line("status", status.cast("string")),
            line("types", type_list),
            line("org", org.cast("string")),
            F.lit("---"),
        ),
        F.lit("\n"),
    )


def markdown(head: Column, text: Column) -> Column:
    """Header followed directly by the cleaned text."""
    return F.concat(head, clean_text(text))


def decode_cp1251(content: Column) -> Column:
    """Windows-1251 bytes to text, undefined bytes becoming U+FFFD.

    Every byte is first read as the code point of the same number, then the
    upper half is mapped; both steps are native expressions.
    """
    upper = bytes(range(0x80, 0x100))
    return F.translate(
        F.decode(content, "iso-8859-1"),
        upper.decode("latin-1"),
        upper.decode("cp1251", errors="replace"),
    )
