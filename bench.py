"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time
from pathlib import Path

from boardtide.plans import bindings, queries_core, queries_flow, queries_payloads  # noqa: F401
from boardtide.session import build_session

HEADLINE = (
    "lifecycle_table", "lifecycle_one_more_day", "asof_newest_partition", "store_round_trip",
    "eligibility", "job_family", "find_in_context", "html_clean_text", "resolve_employers",
    "similar_titles", "merge_kept", "curated_table", "subscription_match", "digest_messages",
    "unsent_diff", "detail_budget", "dedupe_first_wins", "board_verification", "robots_admission",
    "normalise_greenhouse", "normalise_workday", "normalise_portal",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(f"local[{cpus}]", 8, "boardtide-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's compilers and a Python worker before the clock runs
    bindings.QUERIES["status_counts"](spark, sf_dir).collect()
    bindings.QUERIES["name_similarity"](spark, sf_dir).count()
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        bindings.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
