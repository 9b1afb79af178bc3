"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the data set, BENCH_CPUS the number of local cores, BENCH_QUERIES a
comma-separated choice of queries ("all" for every registered one).
"""

from __future__ import annotations

import json
import os
import time

from forumflow.plans.catalog import QUERIES
from forumflow.session import local_session

HEADLINE = [
    "scan_pages",
    "assemble_items",
    "extract_cards",
    "extract_title",
    "extract_paragraphs",
    "filter_promoted",
    "validate_rows",
    "fk_orphans",
    "unique_violations",
    "votes_post",
    "relative_time",
    "combine_join",
    "word_split",
    "lookup_post",
    "lookup_comment",
    "flatten_comments",
    "fold_duplicates",
    "upsert_posts",
    "upsert_comments",
    "post_mark",
    "comment_mark",
    "late_update",
    "reject_report",
    "conversation_comments",
    "sink_roundtrip",
    "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
