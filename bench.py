"""Time the headline queries. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The given files hold one row group, which one task reads. Before the clock starts the tables that the queries read are
written again in a file for each core, as a table of any size would lie.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = HERE + os.pathsep + os.environ.get("PYTHONPATH", "")

HEADLINE = (
    "risk_distribution",
    "stg_transfers",
    "core_address_positions",
    "core_address_netflow_daily",
    "core_cdp_metrics_daily",
    "core_token_metrics_daily",
    "core_whale_addresses",
    "mart_whale_movements",
    "mart_protocol_summary",
    "mart_ecosystem_kpis",
    "mart_risk_dashboard",
    "high_risk",
    "address_flow",
    "token_flow_hourly",
    "decode_transfers",
    "parent_mismatches",
    "risk_metrics",
    "risk_alerts",
    "dq_window_metrics",
    "detect_anomalies",
    "landing_dedup",
    "metric_whale_tvl_share",
    "route_alerts",
    "block_gaps",
    "stream_risk_metrics",
    "stream_token_flow",
)
TABLES = ("orders", "lineitem", "events")


def main() -> None:
    from oracle.registry import ENTRIES
    from tidemark.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    folder = tempfile.mkdtemp(prefix="bench-")
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(int(cpus)).write.parquet(f"{folder}/{table}.parquet")

    def once(name: str) -> float:
        begin = time.perf_counter()
        ENTRIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total median seconds over the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
