"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Every query runs to completion into a
sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from emberlog.plans.registry import QUERIES  # noqa: E402
from emberlog.session import build_session, drop_stages  # noqa: E402

HEADLINE = [
    "triage_by_host",
    "normalize_text",
    "is_informative",
    "line_ordinal",
    "sliding_windows",
    "dedup_incidents",
    "ingest_funnel",
    "label_incidents",
    "label_distribution",
    "stratified_split",
    "shuffle_rows",
    "length_audit",
    "truncate_to_budget",
    "parse_and_repair_mark",
    "triage",
    "pair_predictions",
    "field_accuracy",
    "report_json",
    "stage_valid_rate",
    "leaderboard",
    "stream_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "emberlog-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run(names[0])  # the first job also starts the JVM's compilers
    spent = {name: round(run(name), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    drop_stages(spark)
    spark.stop()


if __name__ == "__main__":
    main()
