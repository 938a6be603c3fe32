"""The rules as SQL functions, for reports and ad-hoc queries: ``register_functions(spark)``.

They are defined in SQL alone, so Spark puts their bodies into the plan of the query that uses them: a filter on
one reaches the scan like any other, and no row goes to Python. ``register_reports`` adds table functions for
a pair of registered tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions.coerce import UNKNOWN_RUN
from tidemark.functions.keys import (
    CONTENT_TYPES,
    DEFAULT_CONTENT_TYPE,
    DEFAULT_EXTENSION,
    KEY_PREFIX,
    MISSING_CODES,
    RETRYABLE_STATUSES,
)
from tidemark.operators.audit import REPORT_COLUMNS
from tidemark.schemas import TableSpec


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _content_type() -> str:
    cases = [f"WHEN endswith(lower(s3_key), {_text(suffix)}) THEN {_text(mime)}" for suffix, mime in CONTENT_TYPES.items()]
    return f"CASE {' '.join(cases)} ELSE {_text(DEFAULT_CONTENT_TYPE)} END"


# Signature, type and body of every scalar function.
SCALAR = {
    "url_extension(url STRING)": (
        "STRING",
        f"lower(substring_index(CASE WHEN contains(url, '.') THEN substring_index(url, '.', -1) ELSE {_text(DEFAULT_EXTENSION)} END, '?', 1))",
    ),
    "object_key(item STRING, url STRING)": ("STRING", f"concat({_text(KEY_PREFIX + '/')}, item, '.', url_extension(url))"),
    "content_type(s3_key STRING)": ("STRING", _content_type()),
    "probe_class(code STRING)": ("STRING", f"CASE WHEN code IN ({', '.join(map(_text, MISSING_CODES))}) THEN 'missing' ELSE 'unknown' END"),
    "is_retryable(status INT)": ("BOOLEAN", f"status IN ({', '.join(map(str, RETRYABLE_STATUSES))})"),
    "is_valid_item(item STRING, url STRING)": ("BOOLEAN", "coalesce(item, '') <> '' AND coalesce(url, '') <> ''"),
    "counter(value BIGINT)": ("BIGINT", "coalesce(value, 0)"),
    "run_name(a STRING, b STRING)": ("STRING", f"coalesce(nullif(a, ''), nullif(b, ''), {_text(UNKNOWN_RUN)})"),
    "run_seconds(started TIMESTAMP, ended TIMESTAMP)": ("BIGINT", "timestampdiff(SECOND, started, ended)"),
    "matches_search(content STRING, query STRING)": ("BOOLEAN", "contains(lower(content), lower(query))"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the rules known to this session's SQL and return their names."""
    for signature, (kind, body) in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    return [s.split("(")[0] for s in SCALAR]


def register_reports(spark: SparkSession, table: str, audit: str, spec: TableSpec) -> list[str]:
    """Table functions over two registered tables (``sources.tables.register``):

    - ``<table>_backlog()``: total and pending rows
    - ``<table>_pending(n)``: the first ``n`` pending rows by key, with the object key they will get
    - ``<audit>_latest(n)``: the last ``n`` runs
    """
    register_functions(spark)
    waits, key = f"{spec.pending_col} IS NULL", ", ".join(spec.keys)
    given = [f"{k} {spec.schema[k].dataType.simpleString()}" for k in spec.keys]
    report = [f"{c} {'STRING' if c.endswith('_id') else 'TIMESTAMP' if c.endswith('_at') else 'BIGINT'}" for c in REPORT_COLUMNS]
    tables = {
        f"{table}_backlog()": (["total BIGINT", "pending BIGINT"], f"SELECT count(*), count_if({waits}) FROM {table}"),
        f"{table}_pending(n INT)": (
            [*given, "url STRING", "next_key STRING"],
            f"SELECT {key}, url, object_key({spec.keys[0]}, url) FROM (SELECT *, row_number() OVER (ORDER BY {key}) AS place "
            f"FROM {table} WHERE {waits}) WHERE place <= n",
        ),
        f"{audit}_latest(n INT)": (
            report,
            f"SELECT {', '.join(REPORT_COLUMNS)} FROM (SELECT *, row_number() OVER (ORDER BY ended_at DESC NULLS FIRST, run_id, dag_id) AS place "
            f"FROM {audit}) WHERE place <= n",
        ),
    }
    for signature, (columns, body) in tables.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE({', '.join(columns)}) RETURN {body}")
    return [s.split("(")[0] for s in tables]
