import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("lexicount-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # The shared folder comes from the session's configuration; only where
    # none is configured do the tests name their own.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexicount-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A new scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="lexicount-test-")


# The reference's six-line word-count fixture, 17 bytes,
# "\n" line ends, no final terminator.
WORDCOUNT_TXT = "A\nB\nC\nD\nA B C D\nA"


@pytest.fixture()
def wordcount_file(scratch):
    path = os.path.join(scratch, "words.txt")
    with open(path, "w", newline="") as f:
        f.write(WORDCOUNT_TXT)
    return path
