"""Time the headline queries, warm; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chatprep.operators.search import search_index  # noqa: E402
from chatprep.plans import queries as q  # noqa: E402
from chatprep.operators.normalize import messages_to_sharegpt  # noqa: E402
from chatprep.plans.jobs import (  # noqa: E402
    build_dataset,
    build_from_conversations,
    validate_dataset,
)
from chatprep.sinks.writers import (  # noqa: E402
    read_index,
    write_index,
    write_jsonl,
    write_merged_csv,
)

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Queries timed as they are registered, besides the jobs below.
REGISTERED = [
    "conversations_checked",
    "dedup_kept",
    "counters",
    "dataset_statistics",
    "json_shapes",
    "merged_pairs",
    "merged_conversations",
    "knowledge_documents",
    "benchmark_terms",
    "search_topk",
    "search_context",
]


def session() -> SparkSession:
    staging = tempfile.mkdtemp(prefix="bench-")  # one machine: this process is the cluster
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", staging)
        .getOrCreate()
    )


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("OFF")
    out = spark.conf.get("spark.checkpoint.dir")
    seconds: dict[str, float] = {}

    def timed(name, work):
        """Median of warm runs: two behind the first, one if that took long."""
        runs = []
        while len(runs) < 2 or (len(runs) < 3 and runs[0] < 8):
            start = time.perf_counter()
            work()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)

    def build(merge):
        built = build_from_conversations(q._conversations(spark, FOLDER), f"{out}/set", merge=merge)
        built.report.collect()

    def index():
        write_index(q._documents(spark, FOLDER), f"{out}/index")

    def look_up():
        stored, _ = read_index(spark, f"{out}/index")
        run(search_index(q._questions(spark, FOLDER), stored))

    def build_file(path, merge):
        build_dataset(spark, path, f"{out}/file-set", merge_same_user=merge).report.collect()

    # Inputs of the file jobs, written before the clock starts.
    turns = messages_to_sharegpt(q._conversations(spark, FOLDER)).select("conversations")
    write_jsonl(turns, f"{out}/talks.jsonl")
    write_merged_csv(q._part_pairs(spark, FOLDER), f"{out}/pairs.csv")
    spark.range(1000).selectExpr("sum(id)").collect()
    timed("build_json_file", lambda: build_file(f"{out}/talks.jsonl", False))
    timed("build_json_file_merged", lambda: build_file(f"{out}/talks.jsonl", True))
    timed("build_csv_file_merged", lambda: build_file(f"{out}/pairs.csv", True))
    timed("validate_json_file", lambda: validate_dataset(spark, f"{out}/talks.jsonl").report.collect())
    timed("build_dataset", lambda: build(False))
    timed("build_dataset_merged", lambda: build(True))
    for name in REGISTERED:
        timed(name, lambda: run(q.QUERIES[name](spark, FOLDER)))
    timed("index_build", index)
    timed("index_search", look_up)

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
