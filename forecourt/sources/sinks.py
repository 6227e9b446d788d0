"""Outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    """The file system of a path, and how to name paths there."""
    name = spark._jvm.org.apache.hadoop.fs.Path
    return name(path).getFileSystem(spark._jsc.hadoopConfiguration()), name


def _save(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def restore_table(spark: SparkSession, path: str) -> None:
    """Finish what an interrupted ``write_table`` left: the table is the old one or the new one, as a whole."""
    path = path.rstrip("/")
    files, name = _files(spark, path)
    olds = sorted((s.getModificationTime(), s.getPath().toString()) for s in files.globStatus(name(f"{path}.old-*")) or ())
    if olds and not files.exists(name(path)):
        files.rename(name(olds.pop()[1]), name(path))
    for _, old in olds:
        files.delete(name(old), True)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write under a fixed name; ``mode`` is overwrite, error (the table must not be there yet) or append.

    A new table is written as a whole beside its place and then moved there. So ``df`` may read the table it
    replaces, a job that fails leaves the old one as it was, and the name never holds a part of a table. A replacement is two
    renames; should the driver be lost between them, the next write, or ``restore_table``, brings the old one back.
    """
    path = path.rstrip("/")
    spark = df.sparkSession
    restore_table(spark, path)
    files, name = _files(spark, path)
    if mode == "append":
        _save(df, path, fmt, mode)
        return path
    if mode not in ("overwrite", "error"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "error" and files.exists(name(path)):
        raise FileExistsError(f"PATH_ALREADY_EXISTS: {path}")
    mark = uuid.uuid4().hex
    beside, old = name(f"{path}.new-{mark}"), name(f"{path}.old-{mark}")
    try:
        _save(df, beside.toString(), fmt, "error")
        if mode == "error" and files.exists(name(path)):
            raise FileExistsError(f"PATH_ALREADY_EXISTS: {path}")
    except Exception:
        files.delete(beside, True)
        raise
    if files.exists(name(path)):
        files.rename(name(path), old)
    if not files.rename(beside, name(path)):
        raise OSError(f"can't move {beside.toString()} to {path}")
    files.delete(old, True)
    return path


def write_run(df: DataFrame, folder: str, name: str, run_id: str, fmt: str = "parquet") -> str:
    """Write under a name that carries the run id; an existing run is never overwritten."""
    return write_table(df, f"{folder}/{name}_{run_id}", fmt, "error")
