"""Read rendered documents back into columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.functions.text import unquote


def parse_markdown(rows: DataFrame, column: str = "markdown") -> DataFrame:
    """Add the header fields and the body of rendered documents.

    The first two lines of dashes delimit the header; each of its lines is
    ``name: value``; of a name given twice the first counts.
    """
    whole = F.col(column)
    head = F.regexp_extract(whole, r"(?s)\A---\n(.*?)\n---\n", 1)
    pairs = F.transform(
        F.split(head, "\n"),
        lambda line: F.struct(
            F.substring_index(line, ": ", 1).alias("key"),
            F.substring(line, F.instr(line, ": ") + 2, F.length(line)).alias("value"),
        ),
    )
    body = F.regexp_extract(whole, r"(?s)\A---\n.*?\n---\n(.*)\z", 1)
    fields = rows.withColumn("_fields", pairs).withColumn("_body", body)

    def field(name: str):
        return F.get(F.filter("_fields", lambda pair: pair["key"] == name), F.lit(0))["value"]

    ids = F.transform(F.split(F.regexp_replace(field("types"), r"[\[\]]", ""), ", "), lambda x: x.try_cast("int"))
    return fields.select(
        *rows.columns,
        unquote(field("source")).alias("head_source"),
        field("dokid").alias("head_id"),
        unquote(field("nreg")).alias("head_reg"),
        unquote(field("title")).alias("head_title"),
        F.try_to_date(field("doc_date")).alias("head_doc_date"),
        F.try_to_date(field("revision_date")).alias("head_revision_date"),
        field("status").try_cast("int").alias("head_status"),
        F.coalesce(ids, F.array().cast("array<int>")).alias("head_types"),
        field("org").alias("head_org"),
        F.col("_body").alias("body"),
    )
