"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
Each query is written to the ``noop`` sink, so every column is computed (a
``count``, as in the first round's figures, lets Spark leave columns out; those
are not comparable).  One small query warms up first.  The shared panel
checkpoint and train statistics are built once and timed as ``prepare``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "baseline_metrics", "causal_impute_transform", "build_windows", "flatten_lags", "target_summary",
    "compact_interactions", "rich_rolling_pollution", "rich_rolling_weather", "city_context",
    "window_interpolate", "rowwise_impute_supplied", "residual_summary", "ensembles_late",
    "grid_blend", "additive_correction_search", "holdout_tail", "rich_interactions", "stationwise_time_impute", "ml_models",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("HOURCAST_SCRATCH", tempfile.mkdtemp(prefix="bench-", dir="/tmp"))
    from hourcast.plans.pipeline import prepare
    from hourcast.plans.registry import QUERIES
    from hourcast.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="hourcast-bench")
    spark.range(1000).selectExpr("sum(id)").write.format("noop").mode("overwrite").save()
    times = {}
    t0 = time.time()
    prepare(spark, sf_dir)
    times["prepare"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_wall_clock", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
