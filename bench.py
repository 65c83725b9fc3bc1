"""Benchmark: run the headline queries on local[$BENCH_CPUS] over
$BENCH_SF_DIR and print one JSON line.

Each query is forced to full evaluation with the ``noop`` sink (no collect
to the driver). Two warm-up queries run first; each query is timed
$BENCH_REPEAT (default 3) times and the median is reported. Frames a query
persists are released before the next run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dimstar.plans import registry  # noqa: E402
from dimstar.session import ensure_checkpoint_dir, local_session  # noqa: E402

HEADLINE = [
    # KPI and chart queries over the star
    "kpi_summary", "kpi_request_count", "kpi_revenue", "kpi_mean_duration", "kpi_active_customers",
    "kpi_cancel_rate", "kpi_retention", "kpi_revenue_by_province", "trend_daily", "trend_weekly",
    "top_suppliers", "province_category", "kpi_summary_filtered",
    # load: validation, dimensions, SCD2, as-of, fact
    "rules_requests", "reject_profile", "customer_dim", "asof_lookup", "request_fact", "dedup_by_hash",
    # state machine, events SCD2 / as-of, checks
    "state_final", "state_step_matrix", "scd2_signup_versions", "asof_purchase",
    "check_not_null_unique", "warehouse_kpi_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cpus, app="dimstar-bench",
                          extra={"spark.sql.shuffle.partitions": str(max(int(cpus), 1) * 2)})
    ensure_checkpoint_dir(spark)
    qs = registry.queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()  # frames persisted inside a query are not reused by the next
        return time.perf_counter() - t0

    for w in ("kpi_request_count", "kpi_summary"):  # warm-up: JIT, file listing caches
        run(w)
    out = {}
    for n in names:
        out[n] = round(statistics.median(run(n) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
