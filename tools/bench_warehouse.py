"""Time the KPI queries over a written warehouse (the dashboard path):
load the driver tables once, write the versioned Parquet warehouse into a
fresh scratch folder, then run each KPI on the star read back (median of 3).
Prints one JSON line. Not part of bench.py's metric."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimstar.model import KpiParams  # noqa: E402
from dimstar.operators import kpis  # noqa: E402
from dimstar.plans.load import load_driver, read_warehouse, write_warehouse  # noqa: E402
from dimstar.session import ensure_checkpoint_dir, local_session  # noqa: E402
from dimstar.sources.driver import DRIVER_CALENDAR  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(8, extra={"spark.sql.shuffle.partitions": "16"})
    ensure_checkpoint_dir(spark)
    path = tempfile.mkdtemp(prefix="run-wh-", dir="/tmp")
    t0 = time.perf_counter()
    write_warehouse(load_driver(spark, sf_dir), path)
    load_s = time.perf_counter() - t0
    star = read_warehouse(spark, path, DRIVER_CALENDAR)
    full = KpiParams.of("1995-01-01", "2001-12-31")
    quarter = KpiParams.of("1996-01-01", "1996-03-31")
    cases = {f"{n}_full": (f, full) for n, f in kpis.KPI_FUNCTIONS.items() if n != "trend"}
    cases.update({f"{n}_quarter": (f, quarter) for n, f in kpis.KPI_FUNCTIONS.items() if n != "trend"})

    def run(fn, p):
        t = time.perf_counter()
        fn(star, p).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    run(kpis.kpi_summary, full)
    out = {k: round(statistics.median(run(f, p) for _ in range(3)), 3) for k, (f, p) in cases.items()}
    print(json.dumps({"metric": "warehouse_kpi_time", "value": round(sum(out.values()), 3), "unit": "sec",
                      "load_and_write_sec": round(load_s, 2), "queries": out}))


if __name__ == "__main__":
    main()
