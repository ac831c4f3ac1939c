"""Jobs survive lost work: task retries and lost cached blocks."""

import json
import os
import subprocess
import sys
import tempfile

from locations import ROOT, SF_SMALL

# Runs in its own process: `local[4,4]` lets a failed task be retried, which a
# plain local master does not. The failing UDF exists only in this test.
SCRIPT = r"""
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4,4]")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("WARN")
from lexicount import table, word_count

@F.udf("string")
def fail_first_attempt(s):
    tc = TaskContext.get()
    if tc.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return s

docs = table(spark, sys.argv[2], "documents")
clean = word_count(docs, "text", multiline=True)
flaky = word_count(docs.select(fail_first_attempt("text").alias("text")), "text", multiline=True)
a = {r.word: r["count"] for r in clean.collect()}
b = {r.word: r["count"] for r in flaky.collect()}
print(json.dumps({"same": a == b, "words": len(a)}))
"""


def test_word_count_survives_task_retries():
    script = os.path.join(tempfile.mkdtemp(prefix="lexicount-ft-"), "ft.py")
    with open(script, "w") as f:
        f.write(SCRIPT)
    out = subprocess.run(
        [sys.executable, script, ROOT, SF_SMALL], capture_output=True, text=True, timeout=300
    )
    assert out.returncode == 0, out.stderr[-2000:]
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["same"] and result["words"] > 1000
    assert "injected task failure" in out.stderr  # the first attempts did fail


def test_named_dataset_recomputed_after_cache_loss(spark):
    from lexicount import get_or_create, is_cached, release, total

    numbers = get_or_create(
        spark, "ft_numbers", lambda: table_numbers(spark)
    )
    first = total(numbers, "l_linenumber").collect()[0].total
    spark.catalog.clearCache()  # every cached block gone, as after losing executors
    again = total(get_or_create(spark, "ft_numbers", lambda: None), "l_linenumber").collect()[0].total
    assert first == again and first > 0
    assert not is_cached(spark, "ft_numbers")
    release(spark, "ft_numbers")


def table_numbers(spark):
    from lexicount import table

    return table(spark, SF_SMALL, "lineitem").select("l_linenumber")
