"""Headline queries, end to end from Parquet to the last row; prints one JSON line.

Each query runs twice and the faster run counts, so that JVM start-up and compilation of
the first plan do not decide the figure. Every row of every result is produced.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from entry.queries import QUERIES  # noqa: E402
from wagerlens.session import local_session  # noqa: E402

HEADLINE = (
    "stg_transactions", "qualified_ftd", "affiliate_attribution", "player_financials", "player_activity",
    "player_ledger", "dim_date", "dim_player", "dim_affiliate", "fct_sessions", "affiliate_performance",
    "fraud_signals", "silver_discovery", "silver_feature_scan", "ledger_reconciliation", "fraud_signal_scan",
    "dashboard_metrics", "merge_upsert", "insert_overwrite", "dq_suite", "assert_running_balance",
    "attribution_rules", "join_fanout", "column_profile", "kpi_retention", "kpi_investigation",
)


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "wagerlens-bench")
    seconds = {name: round(min(timed(spark, folder, name) for _ in range(2)), 3) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
