"""Session settings and the staging area for intermediate tables."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # compressed Parquet is several times larger as rows: keep it from being broadcast by its file size
    "spark.sql.sources.fileCompressionFactor": "8",
    # joins whose partitions turn out small enough hash them instead of sorting both sides
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# deletes the shuffle files of a query as it ends instead of when its plan is collected as garbage
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# rows that one task sorts or puts in a table of keys at once
TASK_ROWS = 1 << 19

_staged_paths: list[str] = []


def build_session(app_name: str = "earshot", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; ``settings`` use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode; on a cluster it would be
    out of reach for the other machines.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="earshot-"))
    return context.getCheckpointDir()


def staging_path(spark: SparkSession, tag: str) -> str:
    """A fresh path below the staging root, remembered for ``release_staged``."""
    path = f"{staging_root(spark).rstrip('/')}/earshot/{tag}-{uuid.uuid4().hex}"
    _staged_paths.append(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside delete their shuffle files as they end; the session's own setting comes back afterwards."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Used where a table feeds several branches: it cuts the lineage, survives
    the loss of executors, and gives the optimizer true sizes to plan with.
    What was shuffled for it is deleted once it is written.
    """
    spark = df.sparkSession
    path = staging_path(spark, tag)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_alone(make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """``stage`` of what ``make`` gives; the tables it staged on the way are deleted."""
    before = len(_staged_paths)
    made = make()
    between = _staged_paths[before:]
    out = stage(made, tag)
    _staged_paths[:] = [path for path in _staged_paths if path not in between]
    _deleted(out.sparkSession, between)
    return out


def unstage(df: DataFrame) -> None:
    """Delete a table that ``stage`` gave and nothing reads any more."""
    folders = {file.rsplit("/", 1)[0].rsplit("/", 1)[1] for file in df.inputFiles()}
    gone = [path for path in _staged_paths if path.rsplit("/", 1)[1] in folders]
    _staged_paths[:] = [path for path in _staged_paths if path not in gone]
    _deleted(df.sparkSession, gone)


def dealt(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """``n`` rows by their keys in as many tasks as bound the rows of one.

    Spark sizes tasks by shuffled bytes, which are few where rows compress
    well, and never makes more of them than the session has shuffle partitions.
    """
    spread = min(rows.sparkSession.sparkContext.defaultParallelism, n // 32_768 + 1)
    return rows.repartition(max(n // TASK_ROWS + 1, spread), *keys)


def release_staged(spark: SparkSession) -> int:
    """Delete the tables this process staged; returns how many there were."""
    removed = _deleted(spark, _staged_paths)
    _staged_paths.clear()
    return removed


def _deleted(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    targets = [jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    return sum(bool(target.getFileSystem(conf).delete(target, True)) for target in targets)


def ship_with_jobs(module_name: str) -> None:
    """Send a module's task functions inside the job, so that executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
