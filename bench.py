"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores. Each query is computed in full twice, into
Spark's noop sink, and the faster run counts.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventloom.queries import QUERIES  # noqa: E402
from eventloom.sources.sinks import null_sink  # noqa: E402

HEADLINE = (
    "fingerprint", "scrub_text", "scrub_text_full", "scrub_url", "scrub_map", "scrub_json",
    "anonymize_ip", "collect_request_context", "error_payload", "dedupe_flush", "dedupe_verdicts",
    "issue_rollup", "buffer_cap", "drop_report", "apply_scope", "attach_trail", "retry_suppress",
    "throttle", "failure_runs", "outages", "dropped_since", "interpolate", "log_wire", "log_batches",
    "error_capture", "log_capture", "fatal_capture", "delivery_report", "stream_throttle",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    null_sink(QUERIES["drop_report"](spark, sf_dir))  # start workers, compile
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            null_sink(QUERIES[name](spark, sf_dir))
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
