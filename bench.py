"""Benchmark the registered queries; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (timed runs per query, default 5; the median is
reported after one warm-up pass over all queries). Every run builds the query and executes it
completely with a ``noop`` write, so all rows are computed and none is
collected; caches of named datasets are freed before every run. A failing query is listed under ``errors`` and ``complete`` is
false (the total then covers the other queries only). Also times the
reference-shaped word count (all words forced into
one partition before the group-by) for comparison; it is not in the total.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

NAMED = {"named_dataset_total", "named_datasets"}
ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def session(cpus: int):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lexicount-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    # spark.checkpoint.dir comes from the session's configuration when set;
    # on a local master without it, sinks.shared_dir makes a private folder.
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_once(spark, build, data_dir) -> float:
    t0 = time.perf_counter()
    build(spark, data_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "5")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    spark = session(cpus)
    from pyspark.sql import functions as F

    from lexicount import table, text_words
    from lexicount.queries import QUERIES, release_named_datasets

    def word_count_single_partition(spark, d):
        """The reference's shape: all words forced into one partition before the group-by."""
        words = table(spark, d, "documents").select(F.explode(text_words("text")).alias("word")).coalesce(1)
        return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))

    names = only or list(QUERIES)
    errors: dict[str, str] = {}

    def attempt(name, build, warm: bool = False) -> float | None:
        try:
            if name in NAMED and not warm:  # its time holds filling the cache
                release_named_datasets(spark, data_dir)
            return run_once(spark, build, data_dir)
        except Exception as e:  # noqa: BLE001 - report the query, keep the others
            errors[name] = f"{type(e).__name__}: {str(e).splitlines()[0][:200] if str(e) else ''}"
            return None

    for name in names:  # warm-up pass: JIT, file listing, caches
        attempt(name, QUERIES[name])
    attempt("reference_shape", word_count_single_partition)

    medians: dict[str, float] = {}
    for name in names:
        if name in errors:
            continue
        ts = [attempt(name, QUERIES[name]) for _ in range(runs)]
        if name not in errors:
            medians[name] = round(statistics.median(ts), 4)

    ref_shape = None
    if "reference_shape" not in errors:
        ts = [attempt("reference_shape", word_count_single_partition) for _ in range(runs)]
        if "reference_shape" not in errors:
            ref_shape = round(statistics.median(ts), 4)

    # Used again, a named dataset is read from its cache.
    warm: dict[str, float] = {}
    for name in NAMED & set(medians):
        ts = [attempt(name, QUERIES[name], warm=True) for _ in range(runs)]
        if name not in errors:
            warm[name] = round(statistics.median(ts), 4)
    release_named_datasets(spark, data_dir)

    m = re.search(r"sf(\d+(?:\.\d+)?)(?![\d.])", os.path.basename(data_dir.rstrip("/")))
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_sec",
                "value": round(sum(medians.values()), 4),
                "complete": not errors,
                "unit": "sec",
                "queries": medians,
                "sf": float(m.group(1)) if m else data_dir,
                "runs": runs,
                "cpus": cpus,
                "spark": spark.version,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                "reference_shape": {"word_count_coalesce1": ref_shape},
                "warm": warm,
                **({"errors": errors} if errors else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
