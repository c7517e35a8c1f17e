"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Every figure is told on standard error as it comes. A query over its time limit is cancelled and counts as
null; when the whole run's limit is near, or the run is asked to end, what there is gets printed.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tallyloom.catalog import QUERIES

HEADLINES = [
    "flagship", "J-6-partial", "SRC-2", "SRC-3", "SRC-5", "PRJ-3", "STR-1", "STR-2", "NUM-3", "DAT-1", "E-9", "E-13",
    "J-5", "J-7", "J-12", "J-14", "WIN-1", "WIN-4", "AGG-3", "AGG-10", "STM-1", "STM-8",
]
#: Run once before any time is taken, at the smallest scale: starts Python workers and compiles common code.
WARM_UP, SMALLEST = ("PRJ-3", "E-13", "STM-1"), "/root/testdata/sf0.001"
#: Seconds for one query and for the whole run.
QUERY_LIMIT, RUN_LIMIT = 240, 1500


def report(took: dict[str, float | None], folder: str) -> None:
    total = round(sum(t for t in took.values() if t is not None), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}), flush=True)


def timed(spark: SparkSession, key: str, folder: str, limit: float) -> float | None:
    """Seconds of one query, or null where it fails or takes longer than the limit."""
    done = threading.Event()

    def cancel() -> None:
        # A query of many jobs is cancelled job by job until it gives up.
        if done.wait(limit):
            return
        while not done.wait(1):
            for stream in spark.streams.active:
                stream.stop()
            spark.sparkContext.cancelAllJobs()

    watch = threading.Thread(target=cancel, daemon=True)
    watch.start()
    start = time.time()
    try:
        QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.time() - start, 3)
    except Exception as e:  # the others are still worth timing
        print(f"{key}: {type(e).__name__} after {time.time() - start:.0f} s: {str(e)[:200]}", file=sys.stderr, flush=True)
        return None
    finally:
        done.set()
        watch.join()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    took: dict[str, float | None] = {}

    def ended(*_) -> None:
        report(took, folder)
        os._exit(0)

    signal.signal(signal.SIGTERM, ended)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted, start = sys.argv[1:] or HEADLINES, time.time()
    for key in WARM_UP:
        timed(spark, key, SMALLEST if os.path.isdir(SMALLEST) else folder, QUERY_LIMIT)
    for key in wanted:
        left = RUN_LIMIT - (time.time() - start)
        took[key] = timed(spark, key, folder, min(QUERY_LIMIT, left)) if left > 0 else None
        print(f"{key} {took[key]}", file=sys.stderr, flush=True)
    report(took, folder)
    spark.stop()


if __name__ == "__main__":
    main()
