"""Time the headline queries: one warm-up run, then the median of the measured runs.

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (local cores), BENCH_RUNS
(measured runs per query), BENCH_QUERIES (comma-separated names, or "all").
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from objsync.plans.queries import CATALOG  # noqa: E402
from objsync.session import local_session  # noqa: E402

HEADLINE = (
    "extract_project", "extract_filter_incremental", "extract_relationship", "extract_topn", "normalize_csv", "csv_roundtrip",
    "json_struct_get", "map_concat_strip", "explode_child", "transform_map_in_pandas", "keymap_merge", "keymap_ambiguous",
    "resolve_keys", "resolve_keys_hot", "resolve_unresolved", "insert_append", "upsert_merge", "upsert_partial", "upsert_keep_last",
    "delete_by_key", "replace_table", "merge_sync", "rejects", "job_results", "audit_filters", "literal_format", "flow_flagship",
    "flow_prospects", "flow_sync", "stream_sync",
)


def seconds(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(CATALOG) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, "objsync-bench", 8)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(CATALOG[name], spark, folder)
        times[name] = round(statistics.median(seconds(CATALOG[name], spark, folder) for _ in range(runs)), 4)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "total seconds of the headline queries (median per query)", "value": round(sum(times.values()), 4), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
