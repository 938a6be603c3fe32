"""Run records: one row per run, from counters that may be missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.coerce import UNKNOWN_DAG, UNKNOWN_RUN, counter, duration_seconds, first_non_empty
from tidemark.operators.ordering import rows_between

RUN_KEY = ["dag_id", "run_id"]

REPORT_COLUMNS = [
    "dag_id",
    "run_id",
    "metadata_inserted",
    "metadata_updated",
    "images_uploaded",
    "download_failures",
    "upload_failures",
    "missing_s3_after_run",
    "duration_seconds",
    "ended_at",
]


def run_identity(
    runs: DataFrame,
    dag_id: list[Column],
    run_id: list[Column],
    logical_date: Column,
    started_at: Column,
    ended_at: Column,
) -> DataFrame:
    """Name each run. Several candidates per name are tried in order; empty ones are passed over."""
    return runs.select(
        first_non_empty(*dag_id, default=UNKNOWN_DAG).alias("dag_id"),
        first_non_empty(*run_id, default=UNKNOWN_RUN).alias("run_id"),
        logical_date.alias("logical_date"),
        started_at.alias("started_at"),
        ended_at.alias("ended_at"),
        duration_seconds(started_at, ended_at).alias("duration_seconds"),
    )


def audit_rows(runs: DataFrame, *metrics: DataFrame) -> DataFrame:
    """Run records from metric frames with one row per run; what is missing counts as zero.

    A run is known by ``dag_id`` and ``run_id`` together: schedulers give several DAGs the same run
    ids. Between them the frames have inserted, updated, images_uploaded, download_failures,
    upload_failures, and pending for the backlog after the run.
    """
    joined = runs
    for frame in metrics:
        joined = joined.join(frame, RUN_KEY, "left")
    return joined.select(
        "dag_id",
        "run_id",
        "logical_date",
        "started_at",
        "ended_at",
        F.col("duration_seconds").cast("bigint").alias("duration_seconds"),
        counter(F.col("inserted")).alias("metadata_inserted"),
        counter(F.col("updated")).alias("metadata_updated"),
        counter(F.col("images_uploaded")).alias("images_uploaded"),
        counter(F.col("download_failures")).alias("download_failures"),
        counter(F.col("upload_failures")).alias("upload_failures"),
        counter(F.col("pending")).alias("missing_s3_after_run"),
    )


def expected_backlog(before: Column, inserted: Column, uploaded: Column) -> Column:
    """The backlog after a run as it follows from the one before: rows only come by inserts, and only wait no
    longer by being published."""
    return before + inserted - uploaded


def backlog_drift(audit: DataFrame) -> DataFrame:
    """Each run with the backlog that follows from the run before it, and by how much the counted one differs.

    Runs follow each other by ``run_id`` within their DAG. Where a run left no record, or a repeated one has
    replaced its counters, the next record shows what is missing. NULL for the first run.
    """
    by_run = Window.partitionBy("dag_id").orderBy("run_id")
    expected = expected_backlog(F.lag("missing_s3_after_run").over(by_run), F.col("metadata_inserted"), F.col("images_uploaded"))
    told = audit.select(*RUN_KEY, "missing_s3_after_run", expected.alias("expected_backlog"))
    return told.withColumn("backlog_drift", F.col("missing_s3_after_run") - F.col("expected_backlog"))


def latest_runs(audit: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` runs by end. A run without an end sorts first; ``run_id`` breaks ties."""
    order = [F.col("ended_at").desc_nulls_first(), F.col("run_id").asc(), F.col("dag_id").asc()]
    return rows_between(audit.select(*REPORT_COLUMNS), order, n)


def run_history(
    deliveries: DataFrame, run: str, keys: list[str], publishes: Column, by: list[str] | None = None
) -> DataFrame:
    """Replay all runs in one pass: counters and backlog after each run, for each table in ``by``.

    A key is inserted by the first run that delivers it, updated by every later one, and
    published by the first run in which one of its rows satisfies ``publishes``. Rows are counted
    per key and run before any key is gathered, so a key has at most one row per run from there
    on; the running sum at the end is over one row per run.
    """
    by = by or []
    per_key = deliveries.groupBy(*by, *keys, run).agg(
        F.count("*").alias("_n"), F.bool_or(publishes).alias("_pub")
    )
    of_key = Window.partitionBy(*by, *keys)
    this = F.col(run)
    per_key = per_key.withColumn("_first", F.min(run).over(of_key)).withColumn(
        "_done", F.min(F.when(F.col("_pub"), this)).over(of_key)
    )
    per_run = per_key.groupBy(*by, run).agg(
        F.sum("_n").alias("extracted"),
        F.count("*").alias("distinct_keys"),
        F.count_if(this == F.col("_first")).alias("inserted"),
        F.count_if(this > F.col("_first")).alias("updated"),
        F.count_if(F.coalesce(this == F.col("_done"), F.lit(False))).alias("published"),
    )
    so_far = Window.partitionBy(*by).orderBy(run).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_run.withColumn("backlog", F.sum(F.col("inserted") - F.col("published")).over(so_far))


def run_outcomes(
    deliveries: DataFrame, run: str, keys: list[str], publishes: Column, success: Column, failure: Column, by: list[str] | None = None
) -> DataFrame:
    """What became of each pending key in each run that delivers it, by the rule of ``run_history``:
    ``success`` in the run that publishes it, ``failure`` before, no row afterwards. Both are
    expressions of the keys."""
    by = by or []
    per_key = deliveries.groupBy(*by, *keys, run).agg(F.bool_or(publishes).alias("_pub"))
    done = F.min(F.when(F.col("_pub"), F.col(run))).over(Window.partitionBy(*by, *keys))
    waiting = per_key.withColumn("_done", done).where(F.col("_done").isNull() | (F.col(run) <= F.col("_done")))
    outcome = F.when(F.col("_pub"), success).otherwise(failure)
    return waiting.select(*by, *keys, run, outcome.alias("outcome"))
