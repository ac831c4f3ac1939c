"""Write PLANS.md: the final physical plan of every registered query.

Usage: python tools/dump_plans.py [data_dir] [out_file]
Each query is executed once (rows are counted on the executors, none is
collected) so the adaptive plan is final; ``*(n)`` marks whole-stage codegen.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


import re

_NODE_LINE = re.compile(r"^\s*(?:[:|]\s*)*(?:\+- |:- )?(?:\*\(\d+\) )?[A-Z][A-Za-z]+|^\+- ==")


def readable(plan: str) -> str:
    """Plan text with line breaks inside expression literals shown as escapes."""
    plan = plan.replace("\r", "\\r")
    out: list[str] = []
    for line in plan.split("\n"):
        if out and not _NODE_LINE.match(line):
            out[-1] += "\\n" + line
        else:
            out.append(line)
    return "\n".join(out)


def main() -> None:
    from pyspark.sql import SparkSession

    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from lexicount.queries import QUERIES

    parts = [
        "# Physical plans\n",
        f"Final adaptive plans of every registered query over `{data_dir}` on `local[8]`, "
        "8 shuffle partitions, generated by `tools/dump_plans.py`. `*(n)` marks a whole-stage "
        "codegen stage; `Exchange` is a shuffle. No plan depends on the size of its input.\n",
    ]
    for name, build in QUERIES.items():
        df = build(spark, data_dir)
        qe = df._jdf.queryExecution()
        qe.executedPlan().execute().count()
        plan = qe.executedPlan().toString()
        final = readable(plan.split("+- == Initial Plan ==")[0].rstrip())
        parts.append(f"\n## {name}\n\n```\n{final}\n```\n")
    with open(out, "w") as f:
        f.write("".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
