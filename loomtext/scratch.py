"""Scratch tables in the folder all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset and the session runs on this machine alone."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"executors of {master} need a folder that all of them share: set spark.checkpoint.dir")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="loomtext-")
        atexit.register(shutil.rmtree, _own_dir, True)
    return "file://" + _own_dir


def materialize(df: DataFrame) -> DataFrame:
    """df written once to the shared folder and read back: lineage ends there, so a lost executor costs no recomputation.

    Columnar (zstd) rather than checkpoint(): later reads prune columns, and the job runs once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomtext-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _register(spark, path)
    # the schema is known; without it an empty table could not be read back
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def folder(spark: SparkSession) -> str:
    """A folder for files that tasks write and read by pyarrow; deleted as scratch tables are."""
    from pyarrow import fs

    path = f"{shared_dir(spark)}/loomtext-{uuid.uuid4().hex}"
    files, at = fs.FileSystem.from_uri(path)
    files.create_dir(at)
    _register(spark, path)
    return path


def _register(spark: SparkSession, path: str) -> None:
    if not _written:
        atexit.register(release)
    _written.append((spark, path))


def drop(*tables: DataFrame) -> None:
    """Delete scratch tables that materialize gave and that nothing unwritten needs any more."""
    for t in tables:
        path = getattr(t, "_scratch_path", None)
        for entry in [x for x in _written if x[1] == path]:
            _written.remove(entry)
            _delete(*entry)


def release() -> None:
    """Delete all scratch tables. Results that were not yet written are lost; runs at exit by itself."""
    while _written:
        _delete(*_written.pop())


def _delete(spark: SparkSession, path: str) -> None:
    if path.startswith(("file:", "/")):
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
        return
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is gone; the folder's owner cleans up
        pass
