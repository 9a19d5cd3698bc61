"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the cores (default all). BENCH_ALSO_ONE=1
times the queries on one core too, in a session of its own.
"""

from __future__ import annotations

import json
import os
import sys
import time

import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairmill.catalog.queries import QUERIES  # noqa: E402
from pairmill.session import build_session  # noqa: E402

# Query and the table whose rows it consumes.
HEADLINES = {
    "prep_manifest": "conversations",
    "encode_sft": "conversations",
    "exact_dedup": "documents",
    "exact_dedup_late": "documents",
    "stream_audit": "conversations",
    "batch_plan": "conversations",
    "tokenize_codepoints": "conversations",
    "acceptance_report": "conversations",
    "response_audit": "conversations",
    "live_stream_report": "conversations",
    "live_report_table": "conversations",
    "status_changes": "events",
    "job_outcome": "events",
    "epoch_loss": "events",
    "capacity_findings": "documents",
}


def timed(sf_dir: str, cpus: str, runs: int = 3) -> tuple[dict, dict]:
    """Best seconds of each query, and input rows a second."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": str(cores),
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/conversations.parquet").count()

    seconds, rates = {}, {}
    for name, table in HEADLINES.items():
        times = []
        # The first run pays for class loading and code generation.
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
        rows = pq.read_metadata(f"{sf_dir}/{table}.parquet").num_rows
        rates[name] = round(rows / min(times))
    spark.stop()
    return seconds, rates


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    seconds, rates = timed(sf_dir, cpus)
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": rates,
        "cpus": os.cpu_count() if cpus == "*" else int(cpus),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_ALSO_ONE"):
        result["queries_on_one_core"] = timed(sf_dir, "1", runs=2)[0]
    print(json.dumps(result))


if __name__ == "__main__":
    main()
