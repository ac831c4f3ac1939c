"""The operators run unchanged on a streaming text source."""

import os

from lexicount import word_count
from lexicount.streaming import text_stream


def test_streaming_word_count(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("A\nB\nC\nD\nA B C D\nA")
    counts = word_count(text_stream(spark, src))
    q = (
        counts.writeStream.outputMode("complete")
        .format("memory")
        .queryName("wc_stream")
        .option("checkpointLocation", os.path.join(scratch, "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    got = {r.word: r["count"] for r in spark.table("wc_stream").collect()}
    assert got == {"A": 3, "B": 2, "C": 2, "D": 2}


def test_streaming_counts_accumulate_across_batches(spark, scratch):
    src = os.path.join(scratch, "in")
    ckpt = os.path.join(scratch, "ckpt")
    os.makedirs(src)

    def run_batch():
        q = (
            word_count(text_stream(spark, src), keep_empty=True)
            .writeStream.outputMode("complete")
            .format("memory")
            .queryName("wc_acc")
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination(120)
        return {r.word: r["count"] for r in spark.table("wc_acc").collect()}

    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("x  y\nx")
    assert run_batch() == {"x": 2, "": 1, "y": 1}
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("y z\n\n")
    assert run_batch() == {"x": 2, "": 2, "y": 2, "z": 1}
