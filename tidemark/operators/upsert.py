"""Keyed upsert as joins: every resulting row says what happened to it.

A batch row wins as a whole. Whether a batch row exists is decided by a presence flag, never by
``coalesce``, so that an incoming NULL overwrites.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import TableSpec

# A batch may be broadcast only when it has been measured to be within both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(rows: int, size: int) -> bool:
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def is_stale(mine: Column, incoming: Column) -> Column:
    """Whether an incoming row is older than the one in place. A row without event time never replaces
    one that has it, and always one that has none."""
    return mine.isNotNull() & F.coalesce(incoming < mine, F.lit(True))


def _resolve(joined: DataFrame, target_cols: Sequence[str], spec: TableSpec, run_ts: Column, newer_by: str | None) -> DataFrame:
    """Columns of the next table version from a join with ``_t.*`` and ``_b.*`` sides."""
    in_target, given = F.col("_t._in").isNotNull(), F.col("_b._in").isNotNull()
    stale = F.lit(False)
    if newer_by:
        stale = in_target & given & is_stale(F.col(f"_t.{newer_by}"), F.col(f"_b.{newer_by}"))
    in_batch = given & ~stale
    inserted, updated = ~in_target, in_target & in_batch
    out = []
    for c in target_cols:
        if c in spec.keys:
            value = F.coalesce(F.col(f"_t.{c}"), F.col(f"_b.{c}"))
        elif c in spec.update_cols:
            value = F.when(in_batch, F.col(f"_b.{c}")).otherwise(F.col(f"_t.{c}"))
        else:
            value = F.col(f"_t.{c}")
            if c in spec.update_stamps:
                value = F.when(updated, run_ts).otherwise(value)
            if c in spec.insert_stamps:
                value = F.when(inserted, run_ts).otherwise(value)
        out.append(value.alias(c))
    op = F.when(inserted, "insert").when(in_batch, "update").when(stale, "stale").otherwise("keep")
    return joined.select(*out, op.alias("op"))


def _on(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(keys):
        same = F.col(f"_t.{k}") == F.col(f"_b.{k}")
        cond = same if i == 0 else cond & same
    return cond


def upsert(
    target: DataFrame,
    batch: DataFrame,
    spec: TableSpec,
    run_ts: Column,
    broadcast_batch: bool = False,
    newer_by: str | None = None,
) -> DataFrame:
    """Next version of ``target`` after ``batch``, with ``op`` = insert, update, stale or keep.

    Whatever arrives last wins, unless ``newer_by`` names an event time among the update columns: a row
    then replaces only one that is not newer, and ``stale`` marks the rows that kept what they had.

    ``target`` and ``batch`` hold one row per key each (see ``dedupe_last``), so the join has no
    skewed key. ``broadcast_batch`` may be set only for a batch that ``fits_broadcast``; the
    target is not shuffled then. Otherwise both sides are shuffled on the key once.
    """
    keys = list(spec.keys)
    cols = [c for c in target.columns]
    batch = batch.select(*keys, *spec.update_cols)
    t = target.withColumn("_in", F.lit(True))
    b = batch.withColumn("_in", F.lit(True))
    if not broadcast_batch:
        joined = t.alias("_t").join(b.alias("_b"), _on(keys), "full_outer")
        return _resolve(joined, cols, spec, run_ts, newer_by)

    old = t.alias("_t").join(F.broadcast(b).alias("_b"), _on(keys), "left")
    matched = target.select(*keys).join(F.broadcast(batch.select(*keys)), keys, "left_semi")
    fresh = b.join(F.broadcast(matched), keys, "left_anti")
    absent = t.limit(0)
    new = fresh.alias("_b").join(F.broadcast(absent).alias("_t"), _on(keys), "left")
    return _resolve(old, cols, spec, run_ts, newer_by).unionByName(_resolve(new, cols, spec, run_ts, newer_by))


def op_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("op").agg(F.count("*").alias("n"))


def merge_statement(table: str, source: str, spec: TableSpec, newer_by: str | None = None) -> str:
    """The same upsert as ``MERGE INTO`` text, for a catalog whose tables support it.

    ``source`` is a view with one row per key, the update columns, and ``run_ts``. Inserted rows get
    the stamps of an insert, matched ones those of an update; running it again changes nothing else.
    """
    on = " AND ".join(f"t.{k} = s.{k}" for k in spec.keys)
    changed = [f"{c} = s.{c}" for c in spec.update_cols] + [f"{c} = s.run_ts" for c in spec.update_stamps]
    names = [*spec.keys, *spec.update_cols, *spec.insert_stamps]
    values = [f"s.{c}" for c in (*spec.keys, *spec.update_cols)] + ["s.run_ts"] * len(spec.insert_stamps)
    guard = f" AND (t.{newer_by} IS NULL OR s.{newer_by} >= t.{newer_by})" if newer_by else ""
    return (
        f"MERGE INTO {table} t USING {source} s ON {on} "
        f"WHEN MATCHED{guard} THEN UPDATE SET {', '.join(changed)} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) VALUES ({', '.join(values)})"
    )


def load_metrics(items: DataFrame, target_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """extracted, invalid, duplicates, inserted, updated for flagged items, in one row.

    Items are counted per key before anything is joined, so a key that holds much of the batch
    leaves each task as one row.
    """
    keys = list(keys)
    per_key = items.groupBy("valid", *keys).agg(F.count("*").alias("n"))
    known = target_keys.select(*keys).distinct().withColumn("_known", F.lit(True))
    seen = per_key.join(known, keys, "left")
    valid = F.col("valid")
    zero = F.lit(0).cast("bigint")
    return seen.agg(
        F.coalesce(F.sum("n"), zero).alias("extracted"),
        F.coalesce(F.sum(F.when(~valid, F.col("n"))), zero).alias("invalid"),
        F.coalesce(F.sum(F.when(valid, F.col("n") - 1)), zero).alias("duplicates"),
        F.count_if(valid & F.col("_known").isNull()).alias("inserted"),
        F.count_if(valid & F.col("_known").isNotNull()).alias("updated"),
    )
