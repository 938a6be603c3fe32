"""The publication log of a keyed table: what became of the rows that publish runs tried.

Beside the versions of its table a log has::

    path/log/00000012-<run>/...    the outcomes of the twelfth publish run
    path/folded/00000012/...       all runs up to the twelfth as one row per key

A run's outcomes count once their ``_SUCCESS`` is there: in that moment its rows are published, and the
table's files stay as they are. Readers join the log to the current version. The next merge, which writes a
version anyway, takes the keys in, and the version's name says up to which run. What remains of a folded log
are the keys that have failed and still wait, so that neither the files that a run reads nor the rows
of the log grow with the number of runs.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType, TimestampType

from tidemark.operators.reconcile import PUBLISHED
from tidemark.schemas import TableSpec
from tidemark.sources.folders import is_complete, names_in, remove, run_name, state_path

FOLD_AFTER = 8  # runs whose outcomes may lie in folders of their own


class Log(NamedTuple):
    """``folded`` holds the runs up to ``upto``, and ``runs`` are the folders of later ones."""

    folded: str | None
    upto: int
    runs: list[str]
    last: int


def _number(name: str) -> int:
    return int(name[:8])


def current_log(spark: SparkSession, path: str) -> Log:
    root = state_path(spark, path)
    old = [n for n in names_in(spark, f"{root}/folded") if is_complete(spark, f"{root}/folded/{n}")]
    upto = _number(old[-1]) if old else 0
    names = names_in(spark, f"{root}/log")
    done = [n for n in names if _number(n) > upto and is_complete(spark, f"{root}/log/{n}")]
    last = _number(done[-1]) if done else upto
    return Log(f"{root}/folded/{old[-1]}" if old else None, upto, [f"{root}/log/{n}" for n in done], last)


def _stamp(spec: TableSpec) -> DataType:
    return spec.schema[spec.update_stamps[0]].dataType if spec.update_stamps else TimestampType()


def _keys(spec: TableSpec) -> list[StructField]:
    return [StructField(k, spec.schema[k].dataType) for k in spec.keys]


def outcome_schema(spec: TableSpec) -> StructType:
    texts, numbers = ("s3_key", "outcome", "content_type"), ("attempts", "bytes", "number")
    fields = [StructField(n, StringType()) for n in texts] + [StructField(n, LongType()) for n in numbers]
    return StructType([*_keys(spec), *fields, StructField("run_ts", _stamp(spec))])


def _folded_schema(spec: TableSpec) -> StructType:
    fields = [StructField("s3_key", StringType()), StructField("failed", LongType()), StructField("number", LongType())]
    return StructType([*_keys(spec), *fields, StructField("run_ts", _stamp(spec))])


def folder_of(spark: SparkSession, path: str, run: str) -> str | None:
    """The folder of a run's outcomes, if it has committed them."""
    root = f"{state_path(spark, path)}/log"
    own = [n for n in names_in(spark, root) if n[9:] == run_name(run) and is_complete(spark, f"{root}/{n}")]
    return f"{root}/{own[-1]}" if own else None


def read_outcomes(spark: SparkSession, path: str, run: str, spec: TableSpec) -> DataFrame:
    """The manifest of a run: key, object key, outcome, attempts, bytes, content type, time."""
    folder = folder_of(spark, path, run)
    if folder is None:
        raise FileNotFoundError(f"no outcomes of {run} at {path}")
    return spark.read.schema(outcome_schema(spec)).parquet(folder)


def append(spark: SparkSession, path: str, spec: TableSpec, run: str, outcomes: DataFrame, run_ts: Column) -> None:
    """Write what became of a run's rows, one row per key. With that they count."""
    number = current_log(spark, path).last + 1
    schema = outcome_schema(spec)
    rows = outcomes.withColumns({"run_ts": run_ts, "number": F.lit(number)})
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    rows.write.mode("overwrite").parquet(f"{state_path(spark, path)}/log/{number:08d}-{run_name(run)}")


def _by_key(spark: SparkSession, log: Log, spec: TableSpec) -> DataFrame:
    """One row per key: ``s3_key`` with ``number`` and ``run_ts`` of the run that published it, or how
    often it ``failed``, with those of the last time."""
    schema = _folded_schema(spec)
    rows = spark.createDataFrame([], schema)
    if log.runs:
        done = F.col("outcome").isin(*PUBLISHED)
        tried = spark.read.schema(outcome_schema(spec)).parquet(*log.runs)
        tried = tried.withColumns({"s3_key": F.when(done, F.col("s3_key")), "failed": F.when(done, 0).otherwise(1).cast("bigint")})
        rows = tried.select(*schema.fieldNames())
    if log.folded:
        old = spark.read.schema(schema).parquet(log.folded)
        rows = rows.unionByName(old) if log.runs else old
    best = F.max(F.struct(F.col("s3_key").isNotNull(), "number", "s3_key", "run_ts")).alias("_best")
    return rows.groupBy(*spec.keys).agg(best, F.sum("failed").alias("failed")).select(*spec.keys, "_best.s3_key", "failed", "_best.number", "_best.run_ts")


def published(spark: SparkSession, log: Log, spec: TableSpec, after: int) -> DataFrame | None:
    """(key, s3_key, run_ts) of the rows published by runs after ``after``; None if there was no run."""
    if log.last <= after:
        return None
    rows = _by_key(spark, log, spec).where(F.col("s3_key").isNotNull() & (F.col("number") > after))
    return rows.select(*spec.keys, "s3_key", "run_ts")


def attempts(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """(key, failed, tried): in how many runs a waiting row has failed, and when last."""
    rows = _by_key(spark, current_log(spark, path), spec).where(F.col("s3_key").isNull())
    return rows.select(*spec.keys, "failed", F.col("run_ts").alias("tried"))


def fold(spark: SparkSession, path: str, spec: TableSpec, taken: int, least: int = FOLD_AFTER) -> bool:
    """Fold the log if ``least`` runs have come since; False otherwise. ``taken`` is the last run whose keys
    the table has taken in: of the runs up to there only failed keys are kept."""
    log = current_log(spark, path)
    if len(log.runs) < least:
        return False
    rows = _by_key(spark, log, spec).where(F.col("s3_key").isNull() | (F.col("number") > taken))
    rows.write.mode("overwrite").parquet(f"{state_path(spark, path)}/folded/{log.last:08d}")
    return True


def clean(spark: SparkSession, path: str, keep: int) -> int:
    """Remove what later folds hold too, but for the last ``keep`` runs: they can still be resumed."""
    root = state_path(spark, path)
    log = current_log(spark, path)
    names = names_in(spark, f"{root}/log")
    old = [f"{root}/log/{n}" for n in names[: max(0, len(names) - keep)] if _number(n) <= log.upto]
    old += [f"{root}/folded/{n}" for n in names_in(spark, f"{root}/folded") if _number(n) < log.upto]
    return remove(spark, old)
