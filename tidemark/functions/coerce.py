"""Coercions used by the run record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
UNKNOWN_DAG = "unknown_dag"
UNKNOWN_RUN = "unknown_run"


def counter(value: Column) -> Column:
    """A missing counter is zero."""
    return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))


def first_non_empty(*values: Column, default: str | None = None) -> Column:
    """The first value that is neither NULL nor the empty string."""
    tried = [F.nullif(v, F.lit("")) for v in values]
    if default is not None:
        tried.append(F.lit(default))
    return F.coalesce(*tried)


def duration_seconds(started: Column, ended: Column) -> Column:
    """Whole seconds of the true difference, cut towards zero; NULL without a start.

    A difference of two ``unix_timestamp`` values cuts each side first and can be one too many.
    """
    return F.timestamp_diff("SECOND", started, ended)


def run_timestamp(at: str | None = None, ntz: bool = False) -> Column:
    """The run's timestamp: given, or the query's own constant current time."""
    kind = "timestamp_ntz" if ntz else "timestamp"
    return (F.lit(at) if at is not None else F.current_timestamp()).cast(kind)
