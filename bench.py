"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from annalist.session import session
from checks.catalog import QUERIES

HEADLINE = [
    "clean_text", "text_metrics", "frontmatter", "canonical_records", "worklist_metrics", "scd2_documents",
    "scd2_dictionary", "scd2_repeated_keys", "scd2_document_types", "as_of_state", "as_of_join", "overlap_check",
    "version_counts", "quality_score", "corpus_stats", "length_stats", "status_distribution", "success_rate",
    "page_completeness", "windowed_ingest_counts", "history_table", "raw_dual_write",
]


def run(spark, folder: str, name: str) -> float:
    """Seconds to build the query and compute every row."""
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # The first query pays for starting up; the second run of each is warm.
    run(spark, folder, "text_metrics")
    times, rates = {}, {}
    for name in names:
        times[name] = round(min(run(spark, folder, name) for _ in range(2)), 3)
    documents = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name in ("clean_text", "text_metrics", "scd2_documents"):
        if name in times:
            rates[name] = round(documents * (2 if name == "scd2_documents" else 1) / times[name])
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": rates,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
