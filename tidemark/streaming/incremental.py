"""Scheduled runs over a stream of arriving files.

Each run starts the stream with the same checkpoint, takes what has arrived since the last one
(``availableNow``) and stops. The only state is the table; a micro-batch that is delivered twice
resumes under its own name and ends in the same table and the same counters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.audit import audit_run
from tidemark.plans.load import load_run
from tidemark.plans.publish import publish_run
from tidemark.schemas import ITEM_KEY, RUN_AUDIT, WALLPAPERS, TableSpec
from tidemark.session import one_row
from tidemark.sources.blobs import FIRST_WAIT_S
from tidemark.sources.folders import is_complete, make_folder
from tidemark.sources.landing import ARRIVAL, extract_items, stream_pages
from tidemark.sources.tables import clean, count_pending, ensure_table

COUNTERS = ["extracted", "invalid", "duplicates", "inserted", "updated", "stale"]


def incremental_run(
    arriving: DataFrame,
    spec: TableSpec,
    table_path: str,
    audit_path: str,
    state: str,
    dag_id: str,
    run_id: str,
    started_at: Column,
    run_ts: Column,
    order_by: list[str],
    key: str,
    url: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    audit_spec: TableSpec = RUN_AUDIT,
    publish: Callable[[], DataFrame] | None = None,
    newer_by: str | None = None,
    check: bool = False,
    logical_date: Column | None = None,
) -> DataFrame:
    """Load everything that is new in the stream, publish, then record the run.

    ``publish`` is called after the load and returns the counters of a publish run. ``newer_by`` is as for a
    load: a row that arrives late then does not replace a newer one. ``check`` too.

    ``arriving`` holds items, or whatever ``prepare`` makes items from in each micro-batch.

    ``state`` holds the stream's checkpoint, and the counters of every micro-batch under the run
    that first loaded it; it stays the same from run to run. Returns the audit record. A run that
    finds nothing new records zeros; one that is started again under its name after a failure
    records all of its micro-batches.
    """
    spark: SparkSession = arriving.sparkSession
    ensure_table(spark, table_path, spec)
    counters = f"{state}/counters"
    make_folder(spark, counters)
    stream = hashlib.md5(state.encode()).hexdigest()

    def load(batch: DataFrame, batch_id: int) -> None:
        done = f"{counters}/batch={batch_id}"
        if is_complete(spark, done):
            return
        items = prepare(batch) if prepare else batch
        metrics = load_run(
            items, spec, table_path, f"{stream}-{batch_id}", run_ts, order_by, key, url, newer_by=newer_by, check=check
        )
        named = metrics.withColumn("run_id", F.lit(run_id))
        named.coalesce(1).write.mode("overwrite").parquet(done)

    query = (
        arriving.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{state}/checkpoint")
        .foreachBatch(load)
        .start()
    )
    query.awaitTermination()
    fields = ", ".join(f"{c} bigint" for c in COUNTERS)
    loaded = spark.read.schema(f"{fields}, run_id string, batch bigint").parquet(counters)
    metrics = loaded.where(F.col("run_id") == run_id).agg(*[F.sum(c).alias(c) for c in COUNTERS])
    published = publish() if publish else None
    if spec.pending_col:
        remaining = count_pending(spark, table_path, spec)
    else:
        remaining = one_row(spark).select(F.lit(0).cast("bigint").alias("pending"))
    return audit_run(
        spark,
        audit_path,
        dag_id,
        run_id,
        (F.lit(None) if logical_date is None else logical_date).cast(audit_spec.schema["logical_date"].dataType),
        started_at,
        run_ts,
        metrics,
        published,
        remaining,
        run_ts,
        audit_spec,
    )


def streamed_run(
    spark: SparkSession,
    pages: str,
    content_root: str,
    object_root: str,
    table_path: str,
    audit_path: str,
    dag_id: str,
    run_id: str,
    started_at: Column,
    run_ts: Column,
    state: str,
    logical_date: Column | None = None,
    item_limit: int | None = None,
    batch_limit: int = 5,
    spec: TableSpec = WALLPAPERS,
    lines: bool = False,
    wait_s: float = FIRST_WAIT_S,
    newer_by: str | None = None,
    check: bool = False,
    keep: int | None = None,
) -> DataFrame:
    """``daily_run`` over a folder that pages keep coming to: a run takes the files that are new since the one
    before, publishes and records. ``state`` remembers which those were. Returns the audit record."""
    record = incremental_run(
        stream_pages(spark, pages, lines),
        spec,
        table_path,
        audit_path,
        state,
        dag_id,
        run_id,
        started_at,
        run_ts,
        ARRIVAL,
        ITEM_KEY,
        "url",
        prepare=lambda batch: extract_items(batch, item_limit),
        publish=lambda: publish_run(
            table_path, content_root, object_root, f"{run_id}-publish", run_ts, batch_limit, spec=spec, wait_s=wait_s, spark=spark
        ),
        newer_by=newer_by,
        check=check,
        logical_date=logical_date,
    )
    if keep is not None:
        for path in (table_path, audit_path):
            clean(spark, path, keep)
    return record
