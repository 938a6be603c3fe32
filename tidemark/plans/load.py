"""Load run: items -> valid, one row per key -> merged into the table -> exact counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe_last
from tidemark.operators.upsert import fits_broadcast, merge_statement, upsert
from tidemark.operators.validate import flag_valid
from tidemark.schemas import TableSpec
from tidemark.session import one_row
from tidemark.sources.folders import is_complete
from tidemark.sources.tables import merge, merged_ops, run_path


def load_run(
    items: DataFrame,
    spec: TableSpec,
    path: str,
    run: str,
    run_ts: Column,
    order_by: list[str],
    key: str,
    url: str,
    strict: bool = False,
    newer_by: str | None = None,
    check: bool = False,
) -> DataFrame:
    """Merge items into the table at ``path`` and return one row of counters.

    ``run`` names this attempt: calling again with the same name resumes it and gives the same
    counters, a new name loads the items again. The items are written first, flagged as valid or
    not. The counters are read back from that folder and from the written version, never from
    accumulators, so lost and repeated tasks cannot change them. With no valid item the table is
    not touched.

    With ``newer_by``, an update column with an event time, the newest row of a key wins within the batch
    and against the table; rows that come too late are counted as stale. ``check``: see ``tables.merge``.
    """
    spark = items.sparkSession
    folder = run_path(spark, path, run)
    loaded = [*spec.keys, *spec.update_cols]
    kept = [spec.typed(c) for c in loaded] + [F.col(c) for c in order_by if c not in loaded]
    flagged = flag_valid(items.select(*kept), key, url)
    items = staged(flagged, f"{folder}/items")
    counts = _measure(items, spec)
    if counts["valid"]:
        # the update columns only break ties, so that a recomputed task picks the same row
        order = [newer_by, *order_by] if newer_by else order_by
        ties = [c for c in spec.update_cols if c not in order]
        unique = dedupe_last(items.where("valid"), spec.keys, [*order, *ties], strict)
        # Written once: the join forms read it up to three times.
        batch = staged(unique.select(*loaded), f"{folder}/batch").withColumn("run_ts", run_ts)
        # A bucketed table is not moved either way, and its rows stay in their buckets without a broadcast.
        small = not spec.buckets and fits_broadcast(counts["valid"], counts["valid_bytes"])
        merge(
            spark,
            path,
            spec,
            run,
            batch,
            lambda current, changes: upsert(current, changes, spec, run_ts, small, newer_by),
            lambda table, source: merge_statement(table, source, spec, newer_by),
            may_be_empty=False,
            newer_by=newer_by,
            check=check,
        )
    return _metrics(spark, path, run, counts)


def staged(df: DataFrame, folder: str) -> DataFrame:
    """``df`` as written by this run, now or before it was resumed."""
    spark = df.sparkSession
    if not is_complete(spark, folder):
        df.write.mode("overwrite").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _measure(items: DataFrame, spec: TableSpec) -> dict:
    """In one job: the number of items; rows and bytes of the valid ones."""
    width = F.lit(0)
    for c in (*spec.keys, *spec.update_cols):
        width = width + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(16)
    row = items.agg(
        F.count("*").alias("extracted"),
        F.count_if("valid").alias("valid"),
        F.coalesce(F.sum(F.when(F.col("valid"), width)), F.lit(0)).alias("valid_bytes"),
    ).first()
    return row.asDict()


def _metrics(spark: SparkSession, path: str, run: str, counts: dict) -> DataFrame:
    extracted, valid = (F.lit(counts[c]).cast("bigint") for c in ("extracted", "valid"))
    zero = F.lit(0).cast("bigint")
    ops = one_row(spark).select(zero.alias("inserted"), zero.alias("updated"), zero.alias("stale"))
    if counts["valid"]:
        ops = merged_ops(spark, path, run)
    return ops.select(
        extracted.alias("extracted"),
        (extracted - valid).alias("invalid"),
        (valid - F.col("inserted") - F.col("updated") - F.col("stale")).alias("duplicates"),
        "inserted",
        "updated",
        "stale",
    )
