"""Derived keys against existing objects, attempt logs, publish outcomes and their counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import TableSpec

# What can become of a pending row.
DOWNLOAD_FAILURE = "download_failure"
ALREADY_THERE = "already_there"
UPLOADED = "uploaded"
UPLOAD_FAILURE = "upload_failure"
PUBLISHED = (UPLOADED, ALREADY_THERE)

MAX_ATTEMPTS = 4

# A row that always fails is tried again after 64 times the first wait at the latest.
MAX_DOUBLINGS = 6


def reconcile(rows: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Flag every row whose object exists. A key listed twice does not multiply the row."""
    there = manifest.select(key).distinct().withColumn("_there", F.lit(True))
    return (
        rows.join(there, key, "left")
        .withColumn("object_exists", F.col("_there").isNotNull())
        .drop("_there")
    )


def to_upload(rows: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Rows whose object is missing. Repeated manifest keys are dropped before the shuffle."""
    return rows.join(manifest.select(key).distinct(), key, "left_anti")


def attempt_outcome(
    attempts: DataFrame, keys: Sequence[str], order: Sequence[str], ok: Column, limit: int = MAX_ATTEMPTS
) -> DataFrame:
    """Reduce an attempt log: an object succeeds if one of its first ``limit`` attempts does.

    ``attempts`` counts up to the first success. The rank filter also runs before the shuffle,
    and the grouping afterwards reuses the window's partitioning.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    first = order[0]
    tried = (
        attempts.select(*keys, *order, ok.alias("_ok"))
        .withColumn("_try", F.row_number().over(w))
        .where(F.col("_try") <= limit)
    )
    return tried.groupBy(*keys).agg(
        F.bool_or("_ok").alias("ok"),
        F.coalesce(F.min(F.when(F.col("_ok"), F.col("_try"))), F.max("_try"))
        .cast("bigint")
        .alias("attempts"),
        F.min(F.when(F.col("_ok"), F.col(first))).alias("succeeded_at"),
    )


def publish_outcome(content_size: Column, object_exists: Column, put_ok: Column) -> Column:
    """Tested in this order: no bytes, already there, put. An unknown existence means put."""
    return (
        F.when(F.coalesce(content_size, F.lit(0)) == 0, DOWNLOAD_FAILURE)
        .when(F.coalesce(object_exists, F.lit(False)), ALREADY_THERE)
        .when(F.coalesce(put_ok, F.lit(False)), UPLOADED)
        .otherwise(UPLOAD_FAILURE)
    )


def publish_metrics(outcomes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counters of a publish run. Objects found in place count as uploaded."""
    o = F.col("outcome")
    return outcomes.groupBy(*by).agg(
        F.count_if(o.isin(*PUBLISHED)).alias("images_uploaded"),
        F.count_if(o == DOWNLOAD_FAILURE).alias("download_failures"),
        F.count_if(o == UPLOAD_FAILURE).alias("upload_failures"),
    )


def publish_statement(table: str, source: str, keys: Sequence[str], published_col: str = "s3_key", stamp: str = "updated_at") -> str:
    """``apply_outcomes`` as ``MERGE INTO`` text. ``source`` is a view of the published rows, one per
    key, with the object key and ``run_ts``."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return (
        f"MERGE INTO {table} t USING {source} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {published_col} = s.{published_col}, {stamp} = s.run_ts"
    )


def apply_outcomes(
    table: DataFrame,
    outcomes: DataFrame,
    keys: Sequence[str],
    run_ts: Column,
    published_col: str = "s3_key",
    stamp: str = "updated_at",
    broadcast_outcomes: bool = False,
) -> DataFrame:
    """Set the object key of published rows; failed rows stay pending. ``op`` says which changed.

    ``outcomes`` has one row per key. Set ``broadcast_outcomes`` only for a measured batch.
    """
    done = outcomes.where(F.col("outcome").isin(*PUBLISHED)).select(
        *keys, F.col(published_col).alias("s3_key"), run_ts.alias("run_ts")
    )
    return _marked(table, F.broadcast(done) if broadcast_outcomes else done, keys, published_col, stamp)


def apply_published(table: DataFrame, done: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's rows with the object keys of ``done`` (key, s3_key, run_ts; one row per key)."""
    stamp = spec.update_stamps[0] if spec.update_stamps else None
    return _marked(table, done, spec.keys, spec.pending_col, stamp).drop("op")


def _marked(table: DataFrame, done: DataFrame, keys: Sequence[str], published_col: str, stamp: str | None) -> DataFrame:
    done = done.select(*keys, F.col("s3_key").alias("_published"), F.col("run_ts").alias("_at"))
    joined = table.join(done, list(keys), "left")
    hit = F.col("_published").isNotNull()
    out = []
    for c in table.columns:
        if c == published_col:
            out.append(F.coalesce("_published", c).alias(c))
        elif c == stamp:
            out.append(F.when(hit, F.col("_at")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out, F.when(hit, "update").otherwise("keep").alias("op"))


def due_at(created: Column, failed: Column, tried: Column, retry_s: int) -> Column:
    """When a waiting row should be tried: a new one as soon as it is there, one that has failed ``retry_s``
    after the last time, twice that after the second, and so on.

    Rows that are due longest come first, so every row has only so many before it, however many new
    ones arrive, and rows that never succeed take an ever smaller share.
    """
    doublings = F.least(failed - 1, F.lit(MAX_DOUBLINGS))
    wait = (F.lit(retry_s) * F.pow(F.lit(2), doublings)).cast("int")
    return F.when(F.coalesce(failed, F.lit(0)) > 0, F.timestamp_add("SECOND", wait, tried)).otherwise(created)
