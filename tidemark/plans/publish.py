"""Publish run: pending batch -> reconcile -> put -> log -> counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import content_type, object_key
from tidemark.operators.ordering import By
from tidemark.operators.pending import pending_batch
from tidemark.operators.reconcile import (
    PUBLISHED,
    due_at,
    publish_metrics,
    publish_statement,
    reconcile,
)
from tidemark.schemas import ITEM_KEY, WALLPAPERS, TableSpec
from tidemark.session import ship_package
from tidemark.sources import log
from tidemark.sources.blobs import FIRST_WAIT_S, OBJECTS, put_objects, put_tasks, staged_path
from tidemark.sources.folders import CATALOG
from tidemark.sources.tables import count_pending, merge, read_pending, taken_in

# A batch of at most this many rows and bytes (key, URL and object key) may be broadcast.
SMALL_BATCH = 20_000

RETRY_S = 24 * 60 * 60


def decide(batch: DataFrame, content_root: str, manifest: DataFrame | None, small: bool) -> DataFrame:
    """Names of the batch (keys, ``name`` and ``url``): object key, content type, and the place of the staged
    content, which follows from the URL, so that no store is listed. ``object_exists`` is what the
    manifest says, NULL without one: the put step asks the store then."""
    keyed = batch.withColumn("s3_key", object_key(F.col("name"), F.col("url"))).withColumns(
        {
            "content_type": content_type(F.col("s3_key")),
            "content_path": staged_path(content_root, F.col("url")),
        }
    )
    if manifest is None:
        return keyed.withColumn("object_exists", F.lit(None).cast("boolean"))
    if small:  # the batch is bounded by its limit, so the manifest shrinks before the join
        manifest = manifest.join(F.broadcast(keyed.select("s3_key")), "s3_key", "left_semi")
    return reconcile(keyed, manifest, "s3_key")


def by_age(spark: SparkSession, path: str, spec: TableSpec, waiting: DataFrame, retry_s: int) -> tuple[DataFrame, list[str]]:
    """``waiting`` with ``due``, and the columns that order it: what is due longest, then what is oldest."""
    created = spec.insert_stamps[0]
    tried = waiting.join(log.attempts(spark, path, spec), list(spec.keys), "left")
    due = due_at(F.col(created), F.col("failed"), F.col("tried"), retry_s)
    return tried.withColumn("due", due), ["due", created]


def publish_run(
    path: str,
    content_root: str,
    object_root: str,
    run: str,
    run_ts: Column,
    limit: int = 5,
    manifest: DataFrame | None = None,
    order_by: Sequence[Column | By] | None = None,
    spec: TableSpec = WALLPAPERS,
    wait_s: float = FIRST_WAIT_S,
    spark: SparkSession | None = None,
    name: Column | None = None,
    url: Column | None = None,
    retry_s: int = RETRY_S,
) -> DataFrame:
    """Publish at most ``limit`` pending rows and return one row of counters.

    Rows that are due longest come first (``due_at``): new ones in the order of their creation, failed ones
    after a wait that doubles. ``order_by`` gives another order. Objects are written first, then the
    outcomes; with their commit the rows are published, and no table file is written. After a crash in
    between, the next run finds the object in place and marks the row. Rows that failed stay pending. The
    outcomes remain as the run's manifest; see ``log.read_outcomes``. ``run`` names this attempt, as for
    a load. ``name`` and ``url`` are expressions of a row: what its object is called after, and where its
    content comes from.
    """
    spark = spark or SparkSession.getActiveSession()
    ship_package(spark)
    small = limit <= SMALL_BATCH
    keys = list(spec.keys)
    if log.folder_of(spark, path, run) is None:
        waiting = read_pending(spark, path, spec)
        if order_by is None:
            waiting, columns = by_age(spark, path, spec, waiting, retry_s)
            order_by = [By(c) for c in columns]
        named = {"_name": F.col(ITEM_KEY) if name is None else name, "_url": F.col("url") if url is None else url}
        order = [*order_by, *[By(k) for k in keys[:-1]]]
        batch = pending_batch(waiting.withColumns(named), limit, [*keys, *named], keys[-1], pending_col=None, order_by=order)
        tasks = put_tasks(spark, 0)
        if limit > tasks * OBJECTS:
            tasks = put_tasks(spark, min(limit, count_pending(spark, path, spec).first()[0]))
        tasks = min(limit, tasks)
        batch = batch.withColumnsRenamed({"_name": "name", "_url": "url"})
        put = put_objects(decide(batch, content_root, manifest, small), object_root, keys, tasks, wait_s)
        log.append(spark, path, spec, run, put, run_ts)
    outcomes = log.read_outcomes(spark, path, run, spec)
    if path.startswith(CATALOG):
        done = outcomes.where(F.col("outcome").isin(*PUBLISHED)).withColumn("run_ts", run_ts)
        merge(spark, path, spec, run, done, _only_as_statement, lambda table, source: publish_statement(table, source, keys))
    log.fold(spark, path, spec, taken_in(spark, path))
    return publish_metrics(outcomes)


def _only_as_statement(current: DataFrame, changes: DataFrame) -> DataFrame:
    raise ValueError("only tables of a catalog are marked by a merge")
