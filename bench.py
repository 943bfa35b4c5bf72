"""Headline queries at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from skyloom import checks  # noqa: E402
from skyloom.session import local_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "congestion_counts", "congestion_scopes", "congestion_flag", "congestion_trim", "congestion_lookup", "hourly_join",
    "calendar_join", "keyword_articles", "keyword_daily", "movement_table", "record_merge", "delay_advance", "dedup_first",
    "dedup_none", "dup_report", "repair_pairs", "repair_left", "null_profile", "placeholder_scan", "fill_both_ways",
    "purge_columns", "training_table", "signoff_table", "signoff_indicators", "normalise_text", "wind", "icing", "date_parts",
    "ordinal_encode", "medians", "split", "correlations", "feature_rank", "roc_auc", "class_metrics", "request_match",
]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    checks.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=CPUS, partitions=int(CPUS), memory="12g")
    # Classes are loaded and compiled before the clock starts.
    for name in ("congestion_lookup", "fill_both_ways"):
        checks.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    times = {name: round(run(spark, name), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
