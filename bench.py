"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from sessionloom.plans import catalogue
from sessionloom.session import local_session

HEADLINE = [
    "flagship", "value_runs", "close_gaps_keep_long", "rolling_median_centred", "hampel", "time_bin_mean", "asof_nearest_tol",
    "resample_linear", "fuse_channels", "exact_quantiles", "spearman", "xcorr_peak", "rule_v1_labels", "rule_v2_labels",
    "rule_variant_totals", "match_events", "event_diagnostics", "ping_anchor", "clock_continuity", "detect_trim",
    "channel_quality", "quality_score", "welch_psd", "motion_energy", "grid_density", "table_identity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    # start the executors and the Python workers before the clock runs
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf_dir).name.removeprefix("sf")}
        )
    )


if __name__ == "__main__":
    main()
