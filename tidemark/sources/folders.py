"""Folders on any file system that Hadoop reaches: what exists, and which writes have committed."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import work_dir

CATALOG = "catalog:"


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.mkdirs(p)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it is not there."""
    fs, p = hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, paths: Iterable[str]) -> int:
    """Remove folders with all that is in them; returns how many there were."""
    return sum(bool(hadoop(spark, x)[0].delete(hadoop(spark, x)[1], True)) for x in paths)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that a frame is read from; 0 for rows that come from no file."""
    uri = df.sparkSession.sparkContext._jvm.java.net.URI
    found = [hadoop(df.sparkSession, uri(x)) for x in df.inputFiles()]
    return sum(fs.getFileStatus(p).getLen() for fs, p in found)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write job to ``path`` has committed."""
    return exists(spark, f"{path}/_SUCCESS")


def mark_complete(spark: SparkSession, path: str) -> None:
    fs, done = hadoop(spark, f"{path}/_SUCCESS")
    fs.create(done, True).close()


def run_name(run: str) -> str:
    """A folder name for a run, which may be any text."""
    readable = re.sub(r"[^A-Za-z0-9_.-]", "_", run)
    return f"{readable}-{hashlib.md5(run.encode()).hexdigest()[:8]}"


def state_path(spark: SparkSession, path: str) -> str:
    """Where runs keep what they need to be resumed: beside the versions, or for a table of a
    catalog below the work folder."""
    if not path.startswith(CATALOG):
        return path
    return f"{work_dir(spark)}/tables/{path.removeprefix(CATALOG)}"
