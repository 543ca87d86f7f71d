"""Time the headline queries; prints one JSON line.

Reads $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS]. Every query is run once to warm the
JVM up; the better of two further runs counts, from building its plan to writing its last row to
the noop sink. A second session then runs every query once more with an event log, in a temporary
folder, for its jobs, megabytes read and megabytes shuffled; those runs are not timed.

``calibration`` is the time of a fixed job that reads nothing and depends on no code of this
repository: divide by it to compare figures of different machines or days.
"""

import json
import os
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from peerscore.plans.queries import QUERIES  # noqa: E402
from peerscore.session import scratch_scope  # noqa: E402

HEADLINE = [
    "bronze_scan", "tile_topk", "sweep_stats", "silver_flatten", "drop_funnel", "silver_merge",
    "silver_merge_shuffled", "silver_table", "silver_table_bucketed", "district_stats",
    "district_stats_exact", "gold_scored", "gold_unqualified", "gap_customer_nation",
    "gap_part_brand", "gap_event_type", "gate_silver", "gate_gold", "publish_counts", "full_run",
]


#: The local property that tells which query a job belongs to.
TAG = "peerscore.query"


def plan_figures(folder: str) -> dict[str, dict[str, float]]:
    """Jobs, MB read and MB written to shuffles of each tagged query."""
    jobs, read, shuffled, owner = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for path in Path(folder).iterdir():
        with path.open() as lines:
            for event in map(json.loads, lines):
                if event["Event"] == "SparkListenerJobStart":
                    if name := event.get("Properties", {}).get(TAG):
                        jobs[name] += 1
                        owner.update({i: name for i in event["Stage IDs"] if i not in owner})
                elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in owner:
                    name, metrics = owner[event["Stage ID"]], event.get("Task Metrics") or {}
                    read[name] += metrics.get("Input Metrics", {}).get("Bytes Read", 0)
                    written = metrics.get("Shuffle Write Metrics", {})
                    shuffled[name] += written.get("Shuffle Bytes Written", 0)
    return {
        x: {"jobs": jobs[x], "read_mb": round(read[x] / 1e6, 2), "shuffle_mb": round(shuffled[x] / 1e6, 2)}
        for x in jobs
    }


def session(cpus: str, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("peerscore-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    with scratch_scope(spark):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def calibration(spark: SparkSession) -> float:
    """Seconds to hash and group 40,000,000 numbers; the best of three runs."""
    def once() -> float:
        start = time.perf_counter()
        numbers = spark.range(40_000_000).selectExpr("xxhash64(id) AS h")
        numbers.groupBy((numbers.h % 1000).alias("g")).count().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    return min(once() for _ in range(3))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus, **{"spark.eventLog.enabled": "false"})
    fixed = round(calibration(spark), 3)
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
    spark.stop()

    events = tempfile.mkdtemp(prefix="peerscore-events-")
    spark = session(
        cpus, **{
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}",
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        },
    )
    for name in names:
        spark.sparkContext.setLocalProperty(TAG, name)
        run(spark, name, sf_dir)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "calibration": fixed, "plans": plan_figures(events),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
