"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the work of one task does not grow with the tables: a task reads at most so much of a file or of a shuffle.
    # Shuffles start in many parts, which Spark joins up to the size below where there is little
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
}


_LOCAL_FOLDERS: dict[str, str] = {}
_RUN: ContextVar[str | None] = ContextVar("run", default=None)
_KEPT: list[str] = []


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; memory, cores and broadcasts stay the cluster's."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Raise unless days are those of UTC, as ``tune`` sets it; another zone would move rows between days."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError(f"the session's time zone is {zone}, not UTC; see forecourt.session.tune")


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "forecourt") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir, which the driver and all executors see.

    A temporary folder is used only with a local master and nothing configured; on a cluster
    without the setting this raises instead of writing to each machine's own disk. The
    session's checkpoint folder is never changed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if master not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[master] = tempfile.mkdtemp(prefix="forecourt-")
    return _LOCAL_FOLDERS[master]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def run_folder(spark: SparkSession, keep: bool = False) -> Iterator[str]:
    """Intermediate tables written inside the block go to one folder, removed at its end.

    Store the result before leaving the block: frames built in it read that folder. With ``keep`` the folder
    stays for frames that are still to be read, until ``remove_runs``. Inside another run the tables go to
    that run's folder and stay until it ends.
    """
    if _RUN.get():
        yield _RUN.get()
        return
    path = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        if keep:
            _KEPT.append(path)
        else:
            _delete(spark, path)


def remove_runs(spark: SparkSession) -> None:
    """Remove the folders of all kept runs; frames built in them can't be read any more."""
    while _KEPT:
        _delete(spark, _KEPT.pop())


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{_RUN.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; this runs a job.

    Cuts the lineage so that it survives the loss of executors, and gives the planner the
    real size, so that Spark broadcasts it only when it is under the session's threshold.
    """
    spark = df.sparkSession
    path = _new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_seen(df: DataFrame, name: str, **seen: Column) -> tuple[DataFrame, dict]:
    """``materialise``, and aggregates of the rows from the job that writes them (None where there are no rows to see)."""
    found = Observation()
    written = materialise(df.observe(found, *(value.alias(key) for key, value in seen.items())), name)
    values = found.get
    return written, {key: values.get(key) for key in seen}


def materialise_buckets(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``materialise`` in buckets of ``key``: what groups by it, or by it and more, needs no shuffle afterwards.

    A bucket is read by one task, so no key may have more rows than a task should read.
    """
    spark = df.sparkSession
    path = _new_path(spark, name)
    table = f"forecourt_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    written = spark.table(table)
    # the frame knows the files and their buckets; the files stay, as those of every run
    spark.sql(f"DROP TABLE {table}")
    return written


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The settings hold for what is run inside the block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# tables in the same buckets are joined where they are, also by more columns than the buckets' key, and not sorted
IN_BUCKETS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.join.preferSortMergeJoin": "false"}
# a shuffled table is not sorted for a join with one whose parts are small
SMALL_PARTS_HASHED = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m"}
