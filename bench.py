"""Headline benchmark: prints one JSON line.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
(default 8).  Each query is executed to completion with the no-op sink
(every row is produced, nothing is collected); times are wall seconds after
one warm-up query that starts the JVM and Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tsengine.session import get_session  # noqa: E402


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    from tsengine.plans import registry as R
    from tsengine.plans.extract import extract_features

    def minimal_5min(s, d):
        return extract_features(R.aligned(s, d, 300), "minimal", null_policy="drop")

    def efficient_native_hourly(s, d):
        settings = {**R.CHANGE, **R.DISTRIBUTION, **R.AUTOCORR, **R.TREND, **R.LOCATIONS}
        return extract_features(R.aligned(s, d), settings, null_policy="drop")

    def align_5min(s, d):
        return R.aligned(s, d, 300)

    plan = {
        "resample_align_5min": align_5min,
        "json_payload_roundtrip": R.q02_market_chart_json,
        "minimal_features_hourly": R.q11_minimal_features,
        "minimal_features_5min": minimal_5min,
        "efficient_native_hourly": efficient_native_hourly,
        "impute_hourly": R.q18_impute,
        "relevance_hourly": R.q20_relevance,
        "targets_hourly": R.q16_target_log_return,
    }
    # warm-up: JVM, codegen caches, Python workers
    R.q05_resample_last(spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in plan.items():
        t0 = time.time()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf_name, "cpus": cpus}))


if __name__ == "__main__":
    main()
