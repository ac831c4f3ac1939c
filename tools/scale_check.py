"""Scale-up check: word count over N copies of the document texts.

Usage: python tools/scale_check.py SCRATCH_DIR [copies=10] [data_dir=/root/testdata/sf0.1]

Writes ``copies`` copies of ``documents`` (new doc_ids, derived by Spark) as
``4 * copies`` parquet files under SCRATCH_DIR once (a complete copy with
the same number of copies is reused), then times ``word_count`` and the
reference-shaped single-partition plan. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    scratch = sys.argv[1]
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    data_dir = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from lexicount import table, text_words, word_count
    from lexicount.sources import parquet

    path = os.path.join(scratch, f"documents_x{copies}.parquet")
    if os.path.exists(path) and not os.path.exists(os.path.join(path, "_SUCCESS")):
        raise SystemExit(f"{path} is an incomplete copy from an interrupted run; use a new folder")
    if not os.path.exists(path):
        docs = table(spark, data_dir, "documents")
        big = docs.select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")).select(
            (F.col("doc_id") * copies + F.col("copy")).alias("doc_id"), "text"
        )
        big.repartition(4 * copies).write.parquet(path)

    def run(build) -> float:
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def word_count_single_partition_at(p):
        w = parquet(spark, p).select(F.explode(text_words("text")).alias("word")).coalesce(1)
        return w.groupBy("word").agg(F.count(F.lit(1)).alias("count"))

    variants = {
        "word_count": lambda: word_count(parquet(spark, path), "text", multiline=True),
        "reference_shape": lambda: word_count_single_partition_at(path),
    }
    times: dict[str, list[float]] = {k: [] for k in variants}
    for name, build in variants.items():  # warm-up
        run(build)
    for _ in range(3):  # interleaved, so drift in machine speed hits all alike
        for name, build in variants.items():
            times[name].append(run(build))
    out = {"copies": copies, "files": len(parquet(spark, path).inputFiles())}
    out.update({k: round(statistics.median(v), 3) for k, v in times.items()})
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
