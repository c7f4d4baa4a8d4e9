"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the tables, by default /root/testdata/sf0.1
BENCH_CPUS     local cores, by default 8
BENCH_QUERIES  comma-separated names instead of the headline list
BENCH_RUNS     timed runs per query after one warm-up; the best counts
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "txn_reasons", "reason_counts", "account_reasons", "quarantine_unified", "latest_accounts",
    "codes_unique", "promoted", "promoted_as_of_date", "gold_daily", "gold_weekly_account",
    "closing_balance_asof", "mass_conservation", "gold_tieout", "expectations_bronze",
    "referential_gaps", "lineage_trace", "load_reconcile", "load_reconcile_checksum",
    "equivalence_excess", "log_gate", "log_sanitize", "csv_ingest",
    "expectations", "txn_reasons_keep_first", "weekly_tieout", "incremental_run",
)


def main() -> None:
    from tallystone.plans.queries import QUERIES
    from tallystone.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for attempt in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            if attempt:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
