"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` the cores (default 8).
Each query is built and run to its end once, all its rows being computed, after one small warm-up query. ``growth`` is the
time over that of the same query at the tenth of the scale, where those tables are there.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from affilix.catalog import QUERIES  # noqa: E402
from affilix.session import local_session  # noqa: E402

HEADLINE = [
    "clean_text", "explode_distinct", "paper_diff", "string_diff", "route_rules", "collect_job", "html_list_extract",
    "json_extract", "xml_extract", "tfidf_weights", "cosine_neighbours", "bm25_top20", "required_match_search",
    "search_cascade", "vote_best", "best_segment", "gazetteer_parse", "attach_known", "resolve_e2e",
]


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "affilix-bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["concat_affiliation"](spark, folder).write.format("noop").mode("overwrite").save()
    small = os.path.join(os.path.dirname(folder), "sf0.01")
    seconds, growth = {}, {}
    for name in HEADLINE:
        seconds[name] = timed(spark, name, folder)
        if small != folder and os.path.isdir(small):
            # Seconds here over seconds at the small scale.
            growth[name] = round(seconds[name] / timed(spark, name, small), 2)
        print(f"{name}: {seconds[name]} {growth.get(name, '')}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "growth": growth, "sf": os.path.basename(folder).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
