"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from obsledger.plans import QUERIES
from obsledger.session import local_session

HEADLINE = [
    "ledger_by_job",
    "canonical_select",
    "observation_history",
    "instances_upsert",
    "identity_duplicates",
    "content_duplicates_pixel",
    "content_duplicates_file",
    "duplicate_summary",
    "refs_resolve",
    "conflict_classify",
    "series_versions",
    "binding_apply",
    "projection_build",
    "projection_merge",
    "reindex_plan",
    "stale_by_version",
    "item_review",
    "terminal_report",
    "status_fold",
    "transition_check",
    "rate_5m",
    "archive_path",
    "path_version",
    "private_tag_policy",
    "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the engine
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
