"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import logging
import os
import sys
import time
import warnings

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wikiloom.catalog import QUERIES  # noqa: E402
from wikiloom.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_link_resolution",
    "convert_pages_markdown",
    "convert_pages_textile",
    "convert_pages_export",
    "c6_code",
    "c40_lists",
    "p2_wiki_title",
    "j1_space_map",
    "j4_resolved_links",
    "j11_missing_numbers",
    "w1_history",
    "w3_version_line_changes",
    "w6_push_order",
    "w4_longest_streak",
    "a6_log_summary",
    "a8_content_groups",
    "t2_pause_changes",
    "t2_pause_stream",
    "s10_export_objects",
    "plan_site_revisions",
    "plan_export_revisions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warnings.filterwarnings("ignore")
    logging.disable(logging.CRITICAL)
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("OFF")
    # Start the JVM paths and the Python workers before the clock runs.
    QUERIES["p1_identifier"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "pages_converted_per_second": round(pages / seconds["convert_pages_markdown"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
