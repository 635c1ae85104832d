"""Time the headline queries and print one JSON line.

Each query is run to a no-op sink: the whole plan executes, nothing is fetched
to the driver. A warm-up query is run first and not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bourse.session import build_session  # noqa: E402
from registered.queries import QUERIES  # noqa: E402

HEADLINE = [
    "unified_prices", "daily_returns", "rolling_metrics", "benchmark_relative", "daily_prices_locf", "data_gaps",
    "performance_summary", "investment_comparison", "volatility_comparison", "return_correlation",
    "window_returns_observed", "dca_value_curve", "flattened_series", "audit_report_bars", "ledger_upsert",
    "unique_takers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("volatility_comparison")
    seconds = {name: run(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
