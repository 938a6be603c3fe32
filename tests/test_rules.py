"""Late rows, checks before a version counts, backlog by deltas, cleaning, and the rules as SQL functions."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.test_runs import Site
from tidemark.functions.coerce import run_timestamp
from tidemark.functions.keys import content_type, is_retryable, object_key, probe_class, url_extension
from tidemark.functions.sql import register_functions, register_reports
from tidemark.operators.upsert import merge_statement, upsert
from tidemark.operators.validate import is_valid
from tidemark.plans.load import load_run
from tidemark.schemas import RUN_AUDIT, WALLPAPERS
from tidemark.sources.tables import (
    ConstraintViolated,
    current_version,
    ensure_table,
    merge,
    read_table,
    register,
    version_of,
)

SPEC = WALLPAPERS
ITEM = "wallhaven_id string, url string, resolution string, category string, purity string, file_size bigint, pos int"


@pytest.fixture
def path(spark, tmp_path):
    p = str(tmp_path / "table")
    ensure_table(spark, p, SPEC)
    return p


def _load(spark, path, run, rows, **more):
    """``rows`` are (key, event time), the event time in file_size."""
    items = spark.createDataFrame([(k, f"u/{run}", None, None, None, t, n) for n, (k, t) in enumerate(rows)], ITEM)
    at = run_timestamp(f"2024-01-0{run[-1]} 00:00:00")
    return load_run(items, SPEC, path, run, at, ["pos"], "wallhaven_id", "url", **more).first().asDict()


@pytest.mark.parametrize("small", [True, False])
def test_late_rows_do_not_replace_newer_ones(spark, path, monkeypatch, small):
    if not small:
        monkeypatch.setattr("tidemark.operators.upsert.BROADCAST_ROWS", 0)
    _load(spark, path, "r1", [("a", 5), ("b", 5), ("c", None), ("d", 5)], newer_by="file_size")
    # within a batch too the newest wins, not the last to come
    got = _load(spark, path, "r2", [("a", 4), ("b", 9), ("b", 6), ("c", 1), ("d", None), ("e", 1), ("a", 3)], newer_by="file_size")
    assert got == {"extracted": 7, "invalid": 0, "duplicates": 2, "inserted": 1, "updated": 2, "stale": 2}
    rows = {r.wallhaven_id: (r.file_size, r.url, r.updated_at is not None) for r in read_table(spark, path, SPEC).collect()}
    assert rows == {"a": (5, "u/r1", False), "b": (9, "u/r2", True), "c": (1, "u/r2", True), "d": (5, "u/r1", False), "e": (1, "u/r2", False)}
    # an equal time replaces; without the guard whatever comes last wins
    assert _load(spark, path, "r3", [("a", 5)], newer_by="file_size")["updated"] == 1
    assert _load(spark, path, "r4", [("a", 1)]) == {"extracted": 1, "invalid": 0, "duplicates": 0, "inserted": 0, "updated": 1, "stale": 0}
    assert {r.wallhaven_id: r.file_size for r in read_table(spark, path, SPEC).collect()}["a"] == 1


def test_the_guard_is_part_of_the_statement(spark):
    text = merge_statement("db.t", "s", SPEC, newer_by="file_size")
    spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    assert "WHEN MATCHED AND (t.file_size IS NULL OR s.file_size >= t.file_size) THEN UPDATE" in text


def test_a_version_that_breaks_a_constraint_never_counts(spark, path):
    _load(spark, path, "r1", [("a", 1), ("b", 1)], check=True)
    before = current_version(spark, path)
    batch = spark.createDataFrame([("b", "u", None, None, None, 2), ("c", None, None, None, None, 2)], ITEM.removesuffix(", pos int"))
    now = run_timestamp("2024-01-02")

    def twice(current, changes):
        rows = upsert(current, changes, SPEC, now)
        return rows.unionByName(rows.where("wallhaven_id = 'b'"))

    for resolve, found in ((lambda t, b: upsert(t, b, SPEC, now), "not_null url: 1$"), (twice, "unique wallhaven_id: 1")):
        with pytest.raises(ConstraintViolated, match=found):
            merge(spark, path, SPEC, "bad", batch, resolve, check=True)
        assert current_version(spark, path) == before and version_of(spark, path, "bad") is None
        assert read_table(spark, path, SPEC).count() == 2
    assert merge(spark, path, SPEC, "good", batch.where("url IS NOT NULL"), lambda t, b: upsert(t, b, SPEC, now), check=True)
    assert current_version(spark, path).number > before.number and read_table(spark, path, SPEC).count() == 2


def test_a_run_checks_what_it_loads(spark, tmp_path, monkeypatch):
    site = Site(spark, tmp_path)
    site.page("one", ["a", "b"], staged=["a"])
    assert site.run("r1", "one", check=True) == (2, 0, 1, 1, 0, 1)
    site.page("two", ["b", "c"])
    with monkeypatch.context() as m:
        m.setattr("tidemark.plans.load.upsert", lambda t, b, *more: upsert(t, b, *more).withColumn("url", F.lit(None).cast("string")))
        with pytest.raises(ConstraintViolated, match="not_null url: 2"):
            site.run("r2", "two", day=2, check=True)
    assert [r[0] for r in site.rows()] == ["a", "b"]
    assert site.run("r2", "two", day=2, check=True)[:2] == (1, 1)


def test_versions_are_kept_as_asked_and_the_backlog_adds_up(spark, tmp_path):
    site, drift = Site(spark, tmp_path), []
    from tidemark.plans import daily

    real = daily.audit_run
    for day in range(1, 6):
        site.page(f"p{day}", [f"k{day}", f"n{day}"], staged=[f"k{day}"])
        daily.audit_run = lambda *a, **k: (lambda r: (drift.append(r.first().backlog_drift), r)[1])(real(*a, **k))
        try:
            assert site.run(f"r{day}", f"p{day}", day=day, batch_limit=9, keep=2)[2] == 1
        finally:
            daily.audit_run = real
        if day == 3:  # a load that no run records
            _load(spark, site.table, "x3", [("lost", 1)])
    assert drift == [None, 0, 0, 1, 0]
    for table in (site.table, site.audit):
        assert sum(n.startswith("v0") for n in os.listdir(table)) == 2
    assert len(os.listdir(f"{site.table}/runs")) <= 2
    assert len(site.rows()) == 11


URLS = [
    "https://x.cc/a.PNG", "a.png?v=1.2", "https://x.com/path", "a.JPEG#f", "a.", "none", "", None, "https://x/y.jpg?z=.webp", "x.tar.gz",
]


def test_sql_functions_follow_the_same_rules(spark):
    names = register_functions(spark)
    assert {"url_extension", "object_key", "content_type", "is_valid_item"} <= set(names)
    codes = ["404", "NoSuchKey", "NotFound", "403", None, "x", "500", "429", "5.3", "it's"]
    df = spark.createDataFrame([(n, u, c, 424 + n) for n, (u, c) in enumerate(zip(URLS, codes, strict=True))], "n int, url string, code string, status int")
    key = F.col("n").cast("string")
    mine = df.select(
        url_extension(F.col("url")), object_key(key, F.col("url")), content_type(object_key(key, F.col("url"))),
        probe_class(F.col("code")), is_retryable(F.col("status")), is_valid(F.col("code"), F.col("url")),
    )
    theirs = spark.sql(
        "SELECT url_extension(url), object_key(string(n), url), content_type(object_key(string(n), url)), probe_class(code), "
        "is_retryable(status), is_valid_item(code, url) FROM {df}", df=df,
    )
    assert sorted(map(str, map(tuple, mine.collect()))) == sorted(map(str, map(tuple, theirs.collect())))
    times = "TIMESTAMP'2024-01-01 00:00:00.95', TIMESTAMP'2024-01-01 00:00:10.9'"
    row = spark.sql(f"SELECT run_seconds({times}), run_seconds(NULL, now()), counter(NULL), run_name('', NULL), run_name(NULL, 'b')").first()
    assert tuple(row) == (9, None, 0, "unknown_run", "b")


def test_sql_functions_are_inlined(spark, tmp_path):
    register_functions(spark)
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 503), ("b", 200)], "k string, status int").write.parquet(path)
    df = spark.sql("SELECT k FROM {t} WHERE is_retryable(status)", t=spark.read.parquet(path))
    plan = plan_of(df)
    assert "In(status, [" in plan and "Python" not in plan and [r.k for r in df.collect()] == ["a"]


def test_reports_as_table_functions(spark, tmp_path):
    site = Site(spark, tmp_path)
    site.page("one", list("abcd"), staged=["b"])
    site.run("r1", "one")
    register(spark, "walls", site.table, SPEC)
    register(spark, "runs", site.audit, RUN_AUDIT)
    register_reports(spark, "walls", "runs", SPEC)
    assert tuple(spark.sql("SELECT * FROM walls_backlog()").first()) == (4, 3)
    rows = spark.sql("SELECT * FROM walls_pending(2)").collect()
    assert [tuple(r) for r in rows] == [(k, f"https://w.x.cc/{k}.jpg", f"wallpapers/{k}.jpg") for k in "ac"]
    assert [(r.run_id, r.images_uploaded) for r in spark.sql("SELECT * FROM runs_latest(5)").collect()] == [("r1", 1)]
