"""The subset of a table that still waits to be published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import By, rows_between


def pending(table: DataFrame, pending_col: str = "s3_key") -> DataFrame:
    return table.where(F.col(pending_col).isNull())


def pending_batch(
    table: DataFrame,
    limit: int,
    columns: Sequence[str],
    key: str,
    pending_col: str | None = "s3_key",
    order_by: Sequence[Column | By] = (),
) -> DataFrame:
    """At most ``limit`` pending rows, in key order unless ``order_by`` rotates them.

    Without ``pending_col`` all rows of ``table`` are pending. With a fixed order, rows that can never be
    published may fill every batch; an order by ``due_at`` avoids that. The key breaks ties.
    """
    waiting = pending(table, pending_col) if pending_col else table
    if not order_by:
        waiting = waiting.select(*dict.fromkeys([*columns, key]))
    return rows_between(waiting, [*order_by, By(key)], limit).select(*columns)


def backlog(table: DataFrame, pending_col: str = "s3_key") -> DataFrame:
    """Total and pending rows, in one row."""
    return table.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(pending_col).isNull()).alias("pending"),
    )
