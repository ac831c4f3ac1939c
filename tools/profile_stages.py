"""Per-stage times of one registered query, from Spark's event log.

Usage: python tools/profile_stages.py QUERY [data_dir=/root/testdata/sf0.1] [runs=2]

The event log goes to a new scratch folder (no UI, no server). Prints, for the
stages of the last run: tasks, wall time, slowest task, shuffle records and
bytes written, and input rows read.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(log_dir: str):
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    from pyspark.sql import SparkSession

    name = sys.argv[1]
    data_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    runs = int(sys.argv[3]) if len(sys.argv) > 3 else 2
    log_dir = tempfile.mkdtemp(prefix="lexicount-events-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from lexicount.queries import QUERIES

    runs = max(1, runs)
    last_start_ms = 0
    for i in range(runs):
        last_start_ms = int(time.time() * 1000)
        t0 = time.perf_counter()
        QUERIES[name](spark, data_dir).write.format("noop").mode("overwrite").save()
        print(f"run {i}: {time.perf_counter() - t0:.3f} s")
    spark.stop()

    stages, tasks = {}, {}
    for e in read_events(log_dir):
        kind = e["Event"]
        if kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stages[info["Stage ID"]] = info
        elif kind == "SparkListenerTaskEnd":
            tasks.setdefault(e["Stage ID"], []).append(e)
    # The last run's stages: those submitted after it started.
    tail = sorted(sid for sid, info in stages.items() if (info.get("Submission Time") or 0) >= last_start_ms)
    print(f"{'stage':>5} {'tasks':>5} {'wall ms':>8} {'max task ms':>11} {'shuffle recs':>12} {'shuffle bytes':>13} {'input rows':>10}")
    for sid in tail:
        info, ts = stages[sid], tasks.get(sid, [])
        wall = (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0)
        metrics = [t.get("Task Metrics") or {} for t in ts]
        slowest = max((m.get("Executor Run Time", 0) for m in metrics), default=0)
        recs = sum((m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0) for m in metrics)
        sbytes = sum((m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0) for m in metrics)
        rows = sum((m.get("Input Metrics") or {}).get("Records Read", 0) for m in metrics)
        print(f"{sid:>5} {info['Number of Tasks']:>5} {wall:>8} {slowest:>11} {recs:>12} {sbytes:>13} {rows:>10}")


if __name__ == "__main__":
    main()
