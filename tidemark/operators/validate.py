"""Validity of items, and constraints that Parquet tables do not enforce."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import LOAD_COLUMNS, TableSpec
from tidemark.session import one_row
from tidemark.sources.folders import input_bytes

SHARE = 8 * 1024 * 1024  # bytes of input whose keys one task counts
SPREAD = 16  # tasks that count the rows of one key first


def is_valid(key: Column, url: Column) -> Column:
    """Key and URL are both present and not empty. Blanks count as content: nothing is trimmed."""
    key, url = key.cast("string"), url.cast("string")
    return (F.coalesce(key, F.lit("")) != "") & (F.coalesce(url, F.lit("")) != "")


def flag_valid(items: DataFrame, key: str, url: str) -> DataFrame:
    return items.withColumn("valid", is_valid(F.col(key), F.col(url)))


def valid_rows(flagged: DataFrame, columns: Sequence[str] = LOAD_COLUMNS) -> DataFrame:
    """The rows to load, in load order."""
    return flagged.where("valid").select(*columns)


class Check(NamedTuple):
    """What a table should satisfy: columns without NULL, and a key that is unique; either may be empty."""

    df: DataFrame
    table: str
    required: Sequence[str]
    key: Sequence[str]


def table_check(df: DataFrame, table: str, spec: TableSpec) -> Check:
    """What a table's own declaration promises."""
    return Check(df, table, [f.name for f in spec.schema.fields if not f.nullable], spec.keys)


def touched_checks(rows: DataFrame, keys: DataFrame, table: str, spec: TableSpec) -> list[Check]:
    """What the rows that a merge has touched should satisfy: ``rows`` is the new version with ``op``, ``keys``
    has the keys of the batch. Rows that the merge kept were checked when they came, so a sound version
    stays sound, and the work goes with the batch: of the others only the keys are read."""
    changed = rows.where(F.col("op").isin("insert", "update"))
    required = [f.name for f in spec.schema.fields if not f.nullable]
    met = rows.select(*spec.keys).join(keys.select(*spec.keys), list(spec.keys), "left_semi")
    return [Check(changed, table, required, ()), Check(met, table, (), spec.keys)]


def null_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The rows with a NULL in a required column. The filter reaches the Parquet scan, where row
    groups whose statistics show no NULL are skipped: on a sound table hardly any data is read."""
    return df.where(reduce(Column.__or__, [F.col(c).isNull() for c in required]))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their row count.

    Spark merges the shuffle of a plain grouping to so many bytes a task, and keys in order shrink to a few
    bytes each: millions of them in one map. So a large input is dealt out by its size. The rows of one key
    are counted in several tasks first, as nothing is counted before they are dealt.
    """
    shares = -(-input_bytes(df) // SHARE)
    if shares > 1:
        rows = df.select(*key, (F.spark_partition_id() % SPREAD).alias("_from"))
        some = rows.repartition(shares, *key, "_from").groupBy(*key, "_from").agg(F.count("*").alias("n"))
        return some.repartition(shares, *key).groupBy(*key).agg(F.sum("n").alias("n")).where("n > 1")
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def _named(table: str, check: str, column: Column, violations: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        column.alias("column_name"),
        violations.cast("bigint").alias("violations"),
    ]


def _nulls(check: Check) -> DataFrame:
    """One row per NULL."""
    found = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in check.required]))
    rows = null_rows(check.df, check.required).select(F.explode(found).alias("column"))
    return rows.select(*_named(check.table, "not_null", F.col("column"), F.lit(1)))


def _surplus(check: Check) -> DataFrame:
    """One row per repeated key, with the rows that a unique key would have refused."""
    column = F.lit(",".join(check.key))
    return duplicate_keys(check.df, check.key).select(
        *_named(check.table, "unique", column, F.col("n") - 1)
    )


def constraint_report(*checks: Check) -> DataFrame:
    """NOT NULL and UNIQUE as counts of violating rows, one row per check, in one aggregate."""
    spark = checks[0].df.sparkSession
    names = [(c.table, "not_null", r) for c in checks for r in c.required]
    names += [(c.table, "unique", ",".join(c.key)) for c in checks if c.key]
    listed = F.array(*[F.struct(*map(F.lit, n)) for n in names])
    zeros = one_row(spark).select(F.inline(listed).alias("table_name", "check_name", "column_name"))
    parts = [zeros.withColumn("violations", F.lit(0).cast("bigint"))]
    parts += [_nulls(c) for c in checks if c.required] + [_surplus(c) for c in checks if c.key]
    return (
        reduce(DataFrame.union, parts)
        .groupBy("table_name", "check_name", "column_name")
        .agg(F.sum("violations").alias("violations"))
    )


def enforce(report: DataFrame) -> DataFrame:
    """The same report, failing the job at the first check that found something."""
    text = F.concat_ws(" ", "table_name", "check_name", "column_name")
    return report.where(
        F.when(
            F.col("violations") > 0,
            F.raise_error(F.concat(F.lit("constraint violated: "), text)).cast("boolean"),
        ).otherwise(F.lit(True))
    )
