"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion through the ``noop`` sink (every row
is produced, nothing is shipped to the driver). One untimed pass warms the
JVM (codegen, JIT, file footers); the second pass is timed and reported as
``value``/``queries``. The first pass total is reported as ``cold_total``.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ratio_of_aggregates", "ds_visits", "readmission_flag", "kpi_readmission_rate", "kpi_avg_length_of_stay",
    "ds_staffing", "staffing_pressure", "staffing_ratio", "trend_occupancy", "occupancy_by_department",
    "ds_claims", "denial_rate_by_payer", "trend_claim_value", "ds_pharmacy_stock", "stockout_worklist",
    "ds_vitals_alerts", "alerts_per_hour", "row_filter_viewer", "row_filter_strict", "evaluate_rules_rows",
    "evaluate_rules_summary", "cleanse_visits", "cleanse_billing_claims", "cleanse_vitals", "split_valid",
    "rule_uniqueness", "dim_date", "stream_alerts", "breach_reasons", "quarantine_metric", "run_batch_daily",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    from wardlake.plans import registry
    from wardlake.session import get_session

    # one shuffle partition per core locally (AQE coalesces further); a cluster
    # sizes partitions by bytes instead (session.cluster_conf)
    spark = get_session(f"local[{cpus}]", cpus, "wardlake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    qs = registry.queries()

    def run_pass() -> dict:
        times = {}
        for name in names:
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        return times

    cold = run_pass()
    warm = run_pass()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_query_seconds", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "sf": sf, "cold_total": round(sum(cold.values()), 3)}))


if __name__ == "__main__":
    main()
