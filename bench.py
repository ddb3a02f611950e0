"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2; the best run
counts). Every row of a result is computed; results that are files are read back.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from tests.session import make_session  # noqa: E402

HEADLINE = [
    "snapshot_bounded",
    "table_net_changes",
    "change_log_consume",
    "change_log_batches",
    "change_log_page",
    "cdc_records",
    "payload_field_types",
    "compact_latest",
    "compact_dropped_updates",
    "stage_roundtrip_csv",
    "merge_updates",
    "merge_stats",
    "apply_change_log",
    "apply_two_batches",
    "stream_apply",
    "replicate_table",
]


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = make_session()
    spark.range(1000).selectExpr("sum(id)").collect()
    names = sys.argv[1:] or HEADLINE
    times = {name: round(min(seconds(spark, sf_dir, name) for _ in range(runs)), 3) for name in names}
    spark.stop()
    line = {
        "metric": "headline queries, best run",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
