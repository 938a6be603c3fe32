"""The whole scheduled run: extract -> load -> publish -> audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.audit import audit_run
from tidemark.plans.load import load_run, staged
from tidemark.plans.publish import RETRY_S, publish_run
from tidemark.schemas import ITEM_KEY, WALLPAPERS, TableSpec
from tidemark.sources.blobs import FIRST_WAIT_S
from tidemark.sources.landing import ARRIVAL, items_of, listed_files, metrics_of, parsed_pages, read_pages
from tidemark.sources.tables import clean, count_pending, ensure_table, run_path

# Beside the audit record.
TOLD = ("extracted", "invalid", "duplicates", "stale", "pages", "bad_pages", "bad_items")


def daily_run(
    spark: SparkSession,
    pages: str | list[str],
    content_root: str,
    object_root: str,
    table_path: str,
    audit_path: str,
    dag_id: str,
    run_id: str,
    started_at: Column,
    run_ts: Column,
    logical_date: Column | None = None,
    item_limit: int | None = None,
    batch_limit: int = 5,
    manifest: DataFrame | None = None,
    attempt: int = 1,
    spec: TableSpec = WALLPAPERS,
    lines: bool = False,
    wait_s: float = FIRST_WAIT_S,
    ended_at: Column | None = None,
    newer_by: str | None = None,
    retry_s: int = RETRY_S,
    keep: int | None = None,
    check: bool = False,
) -> DataFrame:
    """Run the four steps and return the audit record, with what only the run knows beside it: ``TOLD``.

    ``run_ts`` stamps the rows; the run ends when its audit step starts, unless ``ended_at`` is given.
    ``newer_by`` as for a load, ``retry_s`` as for a publish. With ``keep``, only so many versions of both
    tables remain, and what they do not need is removed (``tables.clean``). With ``check``, a load that
    would break what the table declares raises, and the table stays as it was.

    A step that fails raises, so a failed run leaves no record. Calling again with the same
    ``attempt`` resumes; a new one repeats the run, and its record replaces the old one.
    """
    ensure_table(spark, table_path, spec)
    load_name = f"{run_id}-{attempt}-load"
    landed = read_pages(spark, pages, lines)
    folder = run_path(spark, table_path, load_name)
    parsed = staged(parsed_pages(landed, item_limit), f"{folder}/pages")
    load = load_run(
        items_of(parsed), spec, table_path, load_name, run_ts, ARRIVAL, ITEM_KEY, "url", newer_by=newer_by, check=check
    )
    publish = publish_run(
        table_path,
        content_root,
        object_root,
        f"{run_id}-{attempt}-publish",
        run_ts,
        limit=batch_limit,
        manifest=manifest,
        spec=spec,
        wait_s=wait_s,
        spark=spark,
        retry_s=retry_s,
    )
    record = audit_run(
        spark,
        audit_path,
        dag_id,
        run_id,
        logical_date if logical_date is not None else F.lit(None).cast("timestamp"),
        started_at,
        ended_at if ended_at is not None else F.current_timestamp(),
        load,
        publish,
        count_pending(spark, table_path, spec),
        run_ts,
    )
    files = None if lines else listed_files(landed)
    counted = load.first().asDict() | metrics_of(parsed, files).first().asDict()
    if keep is not None:
        for path in (table_path, audit_path):
            clean(spark, path, keep)
    return record.withColumns({n: F.lit(counted[n]).cast("bigint") for n in TOLD})
