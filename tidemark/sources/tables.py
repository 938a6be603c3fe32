"""Keyed tables: versions of Parquet files, or tables of a catalog that supports ``MERGE INTO``.

A Parquet table is a folder with one folder per version, each the whole table, and the log of its publish
runs (see ``log``)::

    path/v00000007.00000012-<run>/...    the rows; pending ones under pending=true
    path/runs/<run>/...                  what a run keeps to be resumed: items, batch
    path/log/..., path/folded/...        what publish runs did since

The second number is the last publish run whose keys the version holds; what later ones published is joined
from the log. So a publish writes no table file, and a merge is one Spark job that writes the next version.
A version counts once its ``_SUCCESS`` is there: a reader has the old rows or the new ones, and a failed run
leaves the old version. A load rewrites the table once: for large tables give ``catalog:<name>`` instead of a
path, and the same merge runs as ``MERGE INTO`` on a table format that rewrites only what it must. A table
has one writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.reconcile import apply_published
from tidemark.operators.upsert import is_stale
from tidemark.operators.validate import constraint_report, touched_checks
from tidemark.schemas import PENDING, TableSpec
from tidemark.sources import log
from tidemark.sources.buckets import forget, read_bucketed, write_bucketed
from tidemark.sources.folders import CATALOG, is_complete, make_folder, mark_complete, names_in, remove, run_name, state_path


class ConstraintViolated(ValueError):
    """A merge would have left rows that break what the table declares."""


Resolve = Callable[[DataFrame, DataFrame], DataFrame]
Statement = Callable[[str, str], str]


def run_path(spark: SparkSession, path: str, run: str) -> str:
    return f"{state_path(spark, path)}/runs/{run_name(run)}"


# ---- versions ------------------------------------------------------------------------------------


class Version(NamedTuple):
    number: int
    taken: int  # the last publish run whose keys it holds
    run: str
    folder: str


def _versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions, also unfinished ones, the latest first."""
    found = [re.fullmatch(r"v(\d{8})\.(\d{8})-(.*)", n) for n in names_in(spark, path)]
    return [Version(int(m[1]), int(m[2]), m[3], f"{path}/{m[0]}") for m in reversed(found) if m]


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The latest complete version."""
    return next((v for v in _versions(spark, path) if is_complete(spark, v.folder)), None)


def version_of(spark: SparkSession, path: str, run: str) -> str | None:
    """The folder of the version that a run has written."""
    own = [v for v in _versions(spark, path) if v.run == run_name(run)]
    return next((v.folder for v in own if is_complete(spark, v.folder)), None)


def taken_in(spark: SparkSession, path: str) -> int:
    """The last publish run whose keys the table itself holds. A table of a catalog holds them all."""
    if path.startswith(CATALOG):
        return log.current_log(spark, path).last
    version = current_version(spark, path)
    return version.taken if version else 0


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the latest ``keep`` complete versions, and unfinished ones below them.

    Readers of a removed version fail, and its run, called again, is merged anew.
    """
    complete = [v.number for v in _versions(spark, path) if is_complete(spark, v.folder)]
    old = [v.folder for v in _versions(spark, path) if complete[keep - 1 :] and v.number < complete[keep - 1]]
    for folder in old:
        forget(spark, folder)
    return remove(spark, old)


def clean(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove what the latest ``keep`` versions do not need: older ones, the folders of runs that wrote none
    of the kept, and outcomes that are folded. A removed run cannot be resumed; it would run anew."""
    if path.startswith(CATALOG):
        return log.clean(spark, path, keep)
    gone = drop_versions(spark, path, keep) + log.clean(spark, path, keep)
    kept = {v.run for v in _versions(spark, path)}
    return gone + remove(spark, [f"{path}/runs/{n}" for n in names_in(spark, f"{path}/runs") if n not in kept])


def ensure_table(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Create the empty table unless it exists."""
    if path.startswith(CATALOG):
        name = path.removeprefix(CATALOG)
        if not spark.catalog.tableExists(name):
            spark.createDataFrame([], spec.schema).writeTo(name).create()
    elif current_version(spark, path) is None:
        empty = f"{path}/v{0:08d}.{0:08d}-empty"
        make_folder(spark, empty)
        mark_complete(spark, empty)


# ---- reading -------------------------------------------------------------------------------------


def _nullable(spec: TableSpec) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in spec.schema.fields])


def _version(spark: SparkSession, path: str) -> Version:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return version


def _plain(spark: SparkSession, folder: str, spec: TableSpec, more: str = "") -> DataFrame:
    schema = StructType([*_nullable(spec).fields, *([PENDING] if spec.pending_col else [])])
    return spark.read.schema(f"{schema.toDDL()}, {more}" if more else schema).parquet(folder)


def _files(spark: SparkSession, version: Version, spec: TableSpec) -> DataFrame:
    if spec.buckets and version.number:
        split = [PENDING.name] if spec.pending_col else []
        schema = StructType([*_nullable(spec).fields, StructField("op", StringType()), *([PENDING] if spec.pending_col else [])])
        return read_bucketed(spark, version.folder, schema, spec.keys, spec.buckets, split)
    return _plain(spark, version.folder, spec)


def _since(spark: SparkSession, path: str, version: Version, spec: TableSpec) -> DataFrame | None:
    """Rows published since the version was written."""
    return log.published(spark, log.current_log(spark, path), spec, version.taken) if spec.pending_col else None


def read_table(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The table as it is now; a frame that has been read stays with its version."""
    if path.startswith(CATALOG):
        return spark.table(path.removeprefix(CATALOG)).select(*spec.columns)
    version = _version(spark, path)
    rows, done = _files(spark, version, spec).select(*spec.columns), _since(spark, path, version, spec)
    return rows if done is None else apply_published(rows, done, spec)


def read_pending(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The rows that wait to be published, without opening the files of the others."""
    if path.startswith(CATALOG):
        return read_table(spark, path, spec).where(F.col(spec.pending_col).isNull())
    version = _version(spark, path)
    rows, done = _files(spark, version, spec).where(F.col(PENDING.name)), _since(spark, path, version, spec)
    rows = rows.select(*spec.columns)
    return rows if done is None else rows.join(done.select(*spec.keys), list(spec.keys), "left_anti")


def count_pending(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The backlog in one row. No column is read: Parquet footers know the number of rows, and what the
    log has published since is taken off."""
    if path.startswith(CATALOG):
        return read_pending(spark, path, spec).agg(F.count("*").alias("pending"))
    version = _version(spark, path)
    rows, done = _files(spark, version, spec).where(F.col(PENDING.name)), _since(spark, path, version, spec)
    counted = rows.agg(F.count("*").alias("pending"))
    if done is None:
        return counted
    return counted.unionByName(done.agg((-F.count("*")).alias("pending"))).agg(F.sum("pending").alias("pending"))


def register(spark: SparkSession, name: str, path: str, spec: TableSpec) -> None:
    """Make the table known to SQL under ``name``, as it is now."""
    read_table(spark, path, spec).createOrReplaceTempView(name)


def merged_ops(spark: SparkSession, path: str, run: str) -> DataFrame:
    """inserted, updated, kept and stale rows of a merged run, in one row; no row if nothing was merged.

    They are counted in what was written: lost and repeated tasks cannot change them.
    """
    op = F.col("op")
    counts = [F.count_if(op == o).alias(n) for o, n in (("insert", "inserted"), ("update", "updated"), ("keep", "kept"), ("stale", "stale"))]
    folder = f"{run_path(spark, path, run)}/ops" if path.startswith(CATALOG) else version_of(spark, path, run)
    if folder is None:
        return spark.range(0).select(F.lit("").alias("op")).groupBy("op").agg(*counts).drop("op")
    return spark.read.schema("op string").parquet(folder).agg(*counts)


# ---- merging -------------------------------------------------------------------------------------


def merge(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    run: str,
    changes: DataFrame,
    resolve: Resolve,
    statement: Statement | None = None,
    may_be_empty: bool = True,
    newer_by: str | None = None,
    check: bool = False,
) -> bool:
    """Merge ``changes`` (one row per key) into the table; False if there is nothing to merge. A caller
    that knows that there is something saves the look.

    ``resolve(current, changes)`` returns the next version's rows with ``op``, every current row among
    them. For a table of a catalog ``statement(table, source)`` is the same merge as text. A ``run``
    that has been merged is not merged again. ``newer_by`` is the event time that both may be guarded by.

    With ``check`` the rows that the merge has touched must satisfy what the table declares. A version that
    breaks it never counts, and the merge raises; a table of a catalog can only be looked at afterwards.
    """
    changes = changes.withColumns({k: spec.typed(k) for k in spec.keys})
    if path.startswith(CATALOG):
        merged = _merge_into(spark, path, spec, run, changes, statement, newer_by)
        if merged and check:
            rows = read_table(spark, path, spec).join(changes.select(*spec.keys), list(spec.keys), "left_semi")
            _must_hold(rows.withColumn("op", F.lit("update")), changes, path, spec)
        return merged
    if version_of(spark, path, run):
        return True
    if may_be_empty and changes.isEmpty():
        return False
    taken = log.current_log(spark, path).last if spec.pending_col else 0
    rows = resolve(read_table(spark, path, spec), changes).select(*[spec.typed(c) for c in spec.columns], "op")
    last = _versions(spark, path)[0].number
    folder = f"{path}/v{last + 1:08d}.{taken:08d}-{run_name(run)}"
    _write(rows, folder, spec, marked=not check, dealt=last > 0)
    if check:
        written = _plain(spark, folder, spec, "op string")
        _must_hold(written, changes, path, spec)
        mark_complete(spark, folder)
    return True


def _write(rows: DataFrame, folder: str, spec: TableSpec, marked: bool, dealt: bool) -> None:
    split = []
    if spec.pending_col:
        rows, split = rows.withColumn(PENDING.name, F.col(spec.pending_col).isNull()), [PENDING.name]
    if spec.buckets:
        write_bucketed(rows, folder, spec.keys, spec.buckets, split, marked, dealt)
        return
    writer = rows.write.partitionBy(*split) if split else rows.write
    # This option of Hadoop's committer leaves _SUCCESS to us.
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(marked).lower()).mode("overwrite").parquet(folder)


def _must_hold(rows: DataFrame, changes: DataFrame, name: str, spec: TableSpec) -> None:
    report = constraint_report(*touched_checks(rows, changes, name, spec))
    broken = report.where("violations > 0").collect()  # a row per constraint
    if broken:
        found = ", ".join(f"{r.check_name} {r.column_name}: {r.violations}" for r in broken)
        raise ConstraintViolated(f"{name}: {found}")


def _merge_into(
    spark: SparkSession, path: str, spec: TableSpec, run: str, changes: DataFrame, statement: Statement | None, newer_by: str | None
) -> bool:
    """What each change will do is written first; the statement is idempotent, so that a run that was
    lost in between is merged again with the counts of its first time."""
    if statement is None:
        raise ValueError("a table of a catalog needs the merge as a statement")
    table, ops = path.removeprefix(CATALOG), f"{run_path(spark, path, run)}/ops"
    if changes.isEmpty():
        return False
    if not is_complete(spark, ops):
        time = F.col(newer_by) if newer_by else F.lit(None)
        known = spark.table(table).select(*spec.keys, F.lit(True).alias("_known"), time.alias("_mine"))
        given = changes.select(*spec.keys, time.alias("_given")).join(known, list(spec.keys), "left")
        op = F.when(F.col("_known").isNull(), "insert").when(is_stale(F.col("_mine"), F.col("_given")), "stale").otherwise("update")
        given.select(op.alias("op")).write.mode("overwrite").parquet(ops)
    view = f"changes_{uuid.uuid4().hex}"
    changes.createOrReplaceTempView(view)
    spark.sql(statement(table, view))
    spark.catalog.dropTempView(view)
    return True
