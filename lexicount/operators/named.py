"""Named, cached datasets (B18): a registry over session temp views.

A name maps to a temp view of the library's own (``PREFIX`` before the name),
so a user's view of the same name is neither returned nor replaced.
``get_or_create`` builds and caches a dataset only when its name is free. The
cached blocks are kept in memory and, beyond it, on each executor's own disk;
what is lost with an executor is rebuilt from the view's lineage, so a lost
executor costs recomputation, not a wrong answer. Not atomic across threads
sharing one session: two concurrent ``get_or_create`` calls for one name may
both build.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicount._checks import identifier

PREFIX = "lexicount_dataset_"
#: Metadata of a dataset's first column.
_FOLDERS, _STATE = "lexicount.folders", "lexicount.state"


def _view(name: object) -> str:
    return PREFIX + identifier(name, "dataset name")


def _folders(df: DataFrame) -> list[str]:
    """The folders that hold the files ``df`` is read from."""
    return sorted({f.rpartition("/")[0] for f in df.inputFiles()})


def _state(spark: SparkSession, folders: list[str]) -> str:
    """A hash over the files in the folders; none of them is opened."""
    if not folders:
        return ""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    each = F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")
    n, size, total = listed.agg(F.count(F.lit(1)), F.sum("length"), F.sum(each)).first()
    return f"{n} {size} {total}"


def is_current(spark: SparkSession, name: str) -> bool:
    """Whether ``name`` is registered and its input files are as they were."""
    df = get(spark, name)
    if df is None or not df.schema.fields:
        return df is not None
    kept = df.schema.fields[0].metadata
    if _STATE not in kept:
        return True
    try:
        return kept[_STATE] == _state(spark, list(kept[_FOLDERS]))
    except AnalysisException:  # a folder is gone
        return False


def names(spark: SparkSession) -> list[str]:
    """The names of the datasets registered in this session, sorted."""
    views = spark.catalog.listTables(pattern=PREFIX + "*")
    return sorted(v.name[len(PREFIX):] for v in views if v.isTemporary)


def get(spark: SparkSession, name: str) -> DataFrame | None:
    """The dataset registered as ``name``, or None."""
    view = _view(name)
    return spark.table(view) if name.lower() in (n.lower() for n in names(spark)) else None


def get_or_create(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    storage_level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> DataFrame:
    """The dataset ``name``; ``build()`` runs only when the name is absent or
    its input files have changed since.

    A new dataset is registered as a temp view and cached lazily: the first
    action fills the cache, later reads use it.
    """
    existing = get(spark, name)
    if existing is not None:
        if is_current(spark, name):
            return existing
        release(spark, name)
    df = build()
    if not isinstance(df, DataFrame):
        raise ValueError("build() must return a DataFrame")
    if folders := _folders(df) if df.columns else []:
        first = df.schema.fields[0]
        df = df.withMetadata(first.name, {**first.metadata, _FOLDERS: folders, _STATE: _state(spark, folders)})
    # Spark's cache is keyed by plan, and dropping a view frees its plan. A
    # filter that is always true, and optimised away, gives every name a plan
    # of its own.
    df.filter(F.lit(name) == F.lit(name)).createOrReplaceTempView(_view(name))
    spark.catalog.cacheTable(_view(name), storage_level)
    return spark.table(_view(name))


def is_cached(spark: SparkSession, name: str) -> bool:
    return get(spark, name) is not None and spark.catalog.isCached(_view(name))


def release(spark: SparkSession, name: str) -> bool:
    """Unregister ``name`` and free its cache; False if it was not registered.
    Other names keep theirs, whatever they stand for."""
    if get(spark, name) is None:
        return False
    spark.catalog.uncacheTable(_view(name))
    spark.catalog.dropTempView(_view(name))
    return True
