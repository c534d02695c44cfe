"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs in full (noop sink); one warm-up, then the median of BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierwork.plans import QUERIES  # noqa: E402
from tierwork.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_monthly_revenue_eur", "merge_upsert", "merge_stage2", "soft_delete", "scd2_from_log", "scd2_apply_log",
    "point_in_time_lookup", "key_lookup", "best_record", "duplicate_profile", "parent_child", "root_ancestor",
    "hierarchy_flatten", "rule_classify", "match_cascade", "item_sales", "fx_gap_fill", "deferred_spread", "deferred_monthly_totals",
    "ytd_to_monthly", "allocate_prorata", "gp_trueup", "usage_explosion", "history_overlay", "lookup_chain",
    "explode_quantity", "match_external", "report_rows", "wide_vendor_report", "attempts_flatten", "dataset_diff",
    "recon_exceptall", "dq_profile", "add_sequence", "w_07_running_values", "stream_upsert",
]


def run(spark, name: str, root: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for n in names:
        run(spark, n, root)
        seconds[n] = round(statistics.median(run(spark, n, root) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"), "cpus": cpus, "runs": runs,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"), "aqe": spark.conf.get("spark.sql.adaptive.enabled"),
    }))


if __name__ == "__main__":
    main()
