import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.coerce import counter, duration_seconds, first_non_empty, run_timestamp
from tidemark.operators.audit import REPORT_COLUMNS, audit_rows, latest_runs, run_history, run_identity
from tidemark.operators.dedupe import dedupe_last
from tidemark.operators.upsert import load_metrics, upsert
from tidemark.operators.validate import flag_valid
from tidemark.plans.audit import audit_run, no_metrics
from tidemark.plans.queries import q_audit_row
from tidemark.schemas import RUN_AUDIT, TableSpec
from tidemark.session import one_row
from tidemark.sources.tables import read_table


def at(text):
    return F.lit(text).cast("timestamp")


def _one(spark, *cols):
    return tuple(one_row(spark).select(*cols).first())


def test_duration_is_the_truncated_difference(spark):
    start, end = at("2024-01-01 00:00:00.950"), at("2024-01-01 00:00:10.900")
    nothing = F.lit(None).cast("timestamp")
    got = _one(
        spark,
        duration_seconds(start, end).alias("a"),
        duration_seconds(nothing, end).alias("b"),
        duration_seconds(start, nothing).alias("c"),
        duration_seconds(end, start).alias("d"),
    )
    assert got == (9, None, None, -9)


def test_coercions(spark):
    none = F.lit(None)
    got = _one(
        spark,
        counter(none).alias("a"),
        counter(F.lit(3)).alias("b"),
        first_non_empty(none.cast("string"), F.lit(""), F.lit("x"), default="d").alias("c"),
        first_non_empty(F.lit(""), default="unknown_run").alias("d"),
        first_non_empty(F.lit("")).alias("e"),
    )
    assert got == (0, 3, "x", "unknown_run", None)


def test_identity_falls_back(spark):
    runs = one_row(spark)
    none = F.lit(None).cast("string")
    got = run_identity(runs, [F.lit("")], [none, F.lit("")], at(None), at(None), at("2024-01-01")).first()
    assert (got.dag_id, got.run_id, got.duration_seconds) == ("unknown_dag", "unknown_run", None)


def _metrics(spark, **values):
    return one_row(spark).select(*[F.lit(v).cast("bigint").alias(k) for k, v in values.items()])


def _record(spark, path, run_id, load, publish, pending, when, dag_id="dag"):
    return audit_run(
        spark, path, dag_id, run_id, at("2024-01-01"), at("2024-01-01 00:00:00.950"),
        at("2024-01-01 00:00:10.900"), load, publish, _metrics(spark, pending=pending), at(when),
    )


def test_a_run_recorded_again_is_replaced(spark, tmp_path):
    path = str(tmp_path / "audit")
    load = _metrics(spark, inserted=3, updated=1)
    _record(spark, path, "r1", load, None, 4, "2024-02-01")
    _record(spark, path, "r2", load, None, 5, "2024-02-01")
    put = _metrics(spark, images_uploaded=2, download_failures=1, upload_failures=0)
    _record(spark, path, "r1", _metrics(spark, inserted=0, updated=4), put, 2, "2024-02-02")
    rows = {r.run_id: r for r in read_table(spark, path, RUN_AUDIT).collect()}
    assert set(rows) == {"r1", "r2"}
    r = rows["r1"]
    assert (r.metadata_inserted, r.metadata_updated, r.images_uploaded, r.missing_s3_after_run) == (0, 4, 2, 2)
    assert (r.created_at, r.updated_at) == (dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2))
    assert r.duration_seconds == 9 and r.notes is None
    assert rows["r2"].updated_at == dt.datetime(2024, 2, 1)


def test_missing_metrics_become_zeros_and_missing_names_are_filled(spark, tmp_path):
    path = str(tmp_path / "audit")
    record = _record(spark, path, None, None, no_metrics(spark), 0, "2024-02-01", dag_id=None).first()
    assert (record.dag_id, record.run_id) == ("unknown_dag", "unknown_run")
    assert record.metadata_inserted == record.images_uploaded == record.upload_failures == 0
    assert read_table(spark, path, RUN_AUDIT).count() == 1


def test_latest_runs_puts_unfinished_ones_first(spark):
    rows = [(f"r{i}", i if i != 2 else None) for i in range(8)]
    zeros = [F.lit(0).alias(c) for c in REPORT_COLUMNS if c not in ("run_id", "ended_at", "dag_id")]
    audit = spark.createDataFrame(rows, "run_id string, ended_at int").select("*", F.lit("d").alias("dag_id"), *zeros)
    got = latest_runs(audit, 5)
    assert got.columns == REPORT_COLUMNS
    assert [r.run_id for r in got.collect()] == ["r2", "r7", "r6", "r5", "r4"]


def test_history_equals_a_day_by_day_replay(spark):
    rows = [(i, i % 5, f"k{(i * 7) % 11}", (i * 13) % 17) for i in range(120)]
    rows += [(1000 + i, i % 5, "hot", i % 3) for i in range(60)]  # a third of all rows under one key
    events = spark.createDataFrame(rows, "pos int, day int, key string, value int").cache()
    history = {r.day: r for r in run_history(events, "day", ["key"], F.col("value") >= 12).collect()}
    schema = spark.createDataFrame([], "key string, value int, s3_key string, created_at timestamp").schema
    spec = TableSpec(schema, ("key",), ("value",), ("created_at",))
    table, published = spark.createDataFrame([], schema), set()
    for day in range(5):
        batch = events.where(F.col("day") == day)
        got = load_metrics(flag_valid(batch, "key", "key"), table, ["key"]).first()
        h = history[day]
        assert (h.extracted, h.inserted, h.updated) == (got.extracted, got.inserted, got.updated)
        assert h.distinct_keys == got.inserted + got.updated
        assert got.inserted + got.updated + got.invalid + got.duplicates == got.extracted
        out = upsert(table, dedupe_last(batch, ["key"], ["pos"]), spec, run_timestamp("2024-01-01"))
        table = spark.createDataFrame(out.drop("op").collect(), schema)
        new = {r[2] for r in rows if r[1] == day and r[3] >= 12} - published
        published |= new
        assert h.published == len(new)
        assert h.backlog == table.count() - len(published)


def test_runs_of_two_dags_with_one_name_keep_their_own_counters(spark):
    runs = spark.sql(
        "SELECT d AS dag_id, 'r1' AS run_id, DATE'2024-01-01' AS logical_date, NULL AS started_at, NULL AS ended_at, "
        "1 AS duration_seconds FROM VALUES ('a'), ('b') AS t(d)"
    )
    load = spark.sql("SELECT * FROM VALUES ('a', 'r1', 1, 2), ('b', 'r1', 3, 4) AS t(dag_id, run_id, inserted, updated)")
    publish = spark.sql(
        "SELECT * FROM VALUES ('a', 'r1', 5, 6, 7), ('b', 'r1', 8, 9, 10) "
        "AS t(dag_id, run_id, images_uploaded, download_failures, upload_failures)"
    )
    pending = spark.sql("SELECT * FROM VALUES ('a', 'r1', 11), ('b', 'r1', 12) AS t(dag_id, run_id, pending)")
    got = {r["dag_id"]: (r["metadata_inserted"], r["images_uploaded"], r["missing_s3_after_run"]) for r in audit_rows(runs, load, publish, pending).collect()}
    assert got == {"a": (1, 5, 11), "b": (3, 8, 12)}


def test_backlog_follows_from_the_counters_of_the_record(spark):
    rows = q_audit_row(spark, "/root/testdata/sf0.001").orderBy("dag_id", "run_id").collect()
    before = {}
    for r in rows:
        expected = before.get(r["dag_id"], 0) + r["metadata_inserted"] - r["images_uploaded"]
        assert r["missing_s3_after_run"] == expected
        before[r["dag_id"]] = expected
    assert any(r["download_failures"] for r in rows) and any(r["upload_failures"] for r in rows)
