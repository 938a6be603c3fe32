"""One scheduled run as a Spark job: ``spark-submit --py-files ... -m tidemark --help``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.coerce import run_timestamp
from tidemark.plans.daily import daily_run
from tidemark.schemas import WALLPAPERS
from tidemark.streaming.incremental import streamed_run


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    for name in ("pages", "contents", "objects", "table", "audit", "dag-id", "run-id"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--started-at", help="start of the run; without it the record has no duration")
    p.add_argument("--logical-date")
    p.add_argument("--attempt", type=int, default=1, help="a new number repeats the run, the same one resumes it")
    p.add_argument("--item-limit", type=int, help="first items of each page; all by default")
    p.add_argument("--batch-limit", type=int, default=5, help="pending rows to publish")
    p.add_argument("--lines", action="store_true", help="pages are lines, not files")
    p.add_argument("--stream", metavar="STATE", help="take what has come to the folder --pages since the last run; STATE keeps how far that was")
    p.add_argument("--newer-by", choices=WALLPAPERS.update_cols, help="an older row never replaces a newer one by this column")
    p.add_argument("--check", action="store_true", help="a load that would break a constraint fails and changes nothing")
    p.add_argument("--keep", type=int, help="versions to keep of both tables; all by default")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    a = arguments(argv)
    time = lambda text: F.lit(text).cast("timestamp")
    spark = SparkSession.builder.appName(f"tidemark {a.run_id}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # times without an offset are UTC
    run = streamed_run if a.stream else daily_run
    more = {"state": a.stream} if a.stream else {"attempt": a.attempt}
    record = run(
        spark,
        a.pages,
        a.contents,
        a.objects,
        a.table,
        a.audit,
        a.dag_id,
        a.run_id,
        time(a.started_at),
        run_timestamp(),
        logical_date=time(a.logical_date),
        item_limit=a.item_limit,
        batch_limit=a.batch_limit,
        lines=a.lines,
        newer_by=a.newer_by,
        check=a.check,
        keep=a.keep,
        **more,
    ).first()
    return record.asDict()


if __name__ == "__main__":
    print(json.dumps(main(), default=str))
