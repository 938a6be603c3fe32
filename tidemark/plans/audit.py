"""Audit run: one record per run, upserted on (dag_id, run_id)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.coerce import UNKNOWN_DAG, UNKNOWN_RUN
from tidemark.operators.audit import audit_rows, expected_backlog, run_identity
from tidemark.operators.ordering import By, rows_between
from tidemark.operators.upsert import merge_statement, upsert
from tidemark.schemas import RUN_AUDIT, TableSpec
from tidemark.session import one_row
from tidemark.sources.tables import ensure_table, merge, read_table


def no_metrics(spark: SparkSession) -> DataFrame:
    """Stands for a task that returned nothing: every counter of the record becomes zero."""
    names = ["inserted", "updated", "images_uploaded", "download_failures", "upload_failures"]
    return one_row(spark).select(*[F.lit(None).cast("bigint").alias(n) for n in names])


def audit_run(
    spark: SparkSession,
    path: str,
    dag_id: str | None,
    run_id: str | None,
    logical_date: Column,
    started_at: Column,
    ended_at: Column,
    load: DataFrame | None,
    publish: DataFrame | None,
    remaining: DataFrame,
    run_ts: Column,
    spec: TableSpec = RUN_AUDIT,
) -> DataFrame:
    """Write the record of one run and return it. ``load``, ``publish`` and ``remaining`` are
    one-row metric frames; a run that is recorded again replaces its record.

    The returned record also has ``backlog_drift``: by how much the counted backlog differs from that of the
    run recorded last before, with what this one inserted and published; NULL without such a record.
    """
    ensure_table(spark, path, spec)
    text = lambda v: F.lit(v).cast("string")
    runs = run_identity(
        one_row(spark), [text(dag_id)], [text(run_id)], logical_date, started_at, ended_at
    )
    dag, name = dag_id or UNKNOWN_DAG, run_id or UNKNOWN_RUN

    def of_run(metrics: DataFrame | None, *names: str) -> DataFrame:
        metrics = metrics if metrics is not None else no_metrics(spark)
        return metrics.select(F.lit(dag).alias("dag_id"), F.lit(name).alias("run_id"), *names)

    record = audit_rows(
        runs,
        of_run(load, "inserted", "updated"),
        of_run(publish, "images_uploaded", "download_failures", "upload_failures"),
        of_run(remaining, "pending"),
    )
    record = spark.createDataFrame(record.toArrow(), record.schema)  # one row, fixed from here on
    others = read_table(spark, path, spec).where((F.col("dag_id") == dag) & (F.col("run_id") != name))
    before = rows_between(others, [By("updated_at", True), By("run_id", True)], 1).select("missing_s3_after_run").first()
    merge(
        spark,
        path,
        spec,
        f"{name}-{uuid.uuid4().hex}",  # recording twice is harmless, so no attempt is resumed
        record.withColumn("run_ts", run_ts),
        lambda current, changes: upsert(current, changes, spec, run_ts),
        lambda table, source: merge_statement(table, source, spec),
        may_be_empty=False,
    )
    known = F.lit(before[0] if before else None).cast("bigint")
    expected = expected_backlog(known, F.col("metadata_inserted"), F.col("images_uploaded"))
    return record.withColumn("backlog_drift", F.col("missing_s3_after_run") - expected)
