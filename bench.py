"""Wall-clock of the headline queries; prints one JSON line.

Each query runs from the raw events on and its whole result is written to Spark's no-op sink. It
runs twice, and the shorter time counts, since the first run is mostly class loading and code
generation.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from armlens.plans import workload  # noqa: E402
from armlens.session import local_session  # noqa: E402

HEADLINE = (
    "landed_events", "staged_events", "rejects", "contract_violations", "stage_reconciliation",
    "dim_user", "dim_date", "step_events", "user_funnel",
    "mart_kpi_by_group", "mart_guardrails_by_group", "mart_step_dropoff", "mart_daily_funnel",
    "dq_report", "srm_check", "ztest_pvalues", "recommendation", "csv_roundtrip", "full_refresh",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    registered = workload.registered()

    def run(name: str) -> float:
        began = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    seconds = {name: min(run(name), run(name)) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline queries, total wall-clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
