import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordering import By, assign_ids, place_of, rows_between, with_row_index
from tidemark.operators.pending import backlog, pending_batch
from tidemark.operators.search import search_page
from tests.conftest import plan_of


def _numbers(spark, n=5000):
    # many ties in v: a third of all rows share one value
    v = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 101)
    return spark.range(0, n, 1, 16).select(F.col("id"), v.alias("v"))


@pytest.mark.parametrize("offset,limit", [(0, 10), (1000, 777), (4990, 100), (6000, 5), (0, 5000)])
def test_both_ways_give_the_same_rows(spark, offset, limit):
    order = [F.col("v").desc(), F.col("id").asc()]
    df = _numbers(spark)
    want = [r.id for r in df.orderBy(*order).collect()][offset : offset + limit]
    by = [By("v", descending=True), By("id")]
    for got in (rows_between(df, order, limit, offset), rows_between(df, by, limit, offset, deep=0)):
        assert [r.id for r in got.collect()] == want


def test_row_index_is_the_global_position(spark):
    order = [F.col("v").asc(), F.col("id").desc()]
    got = {r.id: r.at for r in with_row_index(_numbers(spark), order, "at").collect()}
    want = [r.id for r in _numbers(spark).orderBy(*order).collect()]
    assert got == {v: i for i, v in enumerate(want)}


def test_large_batches_need_no_job_and_no_folder(spark, monkeypatch):
    monkeypatch.setattr("tidemark.operators.ordering.work_dir", lambda *_: 1 / 0)
    table = _numbers(spark).select(F.col("id").cast("string").alias("id"), F.lit(None).cast("string").alias("s3_key"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    batch = pending_batch(table, 1001, ["id"], "id")
    page = rows_between(_numbers(spark), [By("id")], 24, offset=1008)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs
    assert batch.count() == 1001 and "TakeOrderedAndProject" in plan_of(batch)
    assert page.count() == 24


KINDS = {
    "long": "CAST(id % 5000 AS BIGINT)",
    "hot": "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 101 END",
    "string": "concat('k', id % 900)",
    "double": "CASE id % 11 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') ELSE id / 7 END",
    "timestamp": "timestamp_seconds(1711846800 + id * 61)",
    "timestamp_ntz": "cast(timestamp_seconds(1711846800 + (id % 700) * 61) as timestamp_ntz)",
    "date": "CASE WHEN id % 4 = 0 THEN NULL ELSE date_add(DATE'2024-01-01', cast(id % 90 as int)) END",
}


@pytest.mark.parametrize("kind,down", [(k, i % 2 == 0) for i, k in enumerate(KINDS)])
def test_places_in_columns_of_any_kind(spark, monkeypatch, kind, down):
    """Also with NULLs and NaN, few rows to sort at the end, and many equal ones."""
    monkeypatch.setattr("tidemark.operators.ordering.FEW", 90)
    monkeypatch.setattr("tidemark.operators.ordering.SAMPLE", 60)
    monkeypatch.setattr("tidemark.operators.ordering.MARGIN", 4)
    df = spark.range(0, 3000, 1, 3).selectExpr("id", f"{KINDS[kind]} AS v")
    by = [By("v", down), By("id", not down)]
    want = [r.id for r in df.orderBy(*[b.order for b in by]).collect()]
    for rank in (1, 1499):
        assert [r.id for r in rows_between(df, by, 2, rank, deep=0).collect()] == want[rank : rank + 2]
    place = place_of(df.select("v"), by[:1], 1500)
    values = [r.v for r in df.orderBy(by[0].order).collect()]
    same = [str(v) == str(values[1500]) for v in values]
    assert (place.before, place.upto) == (same.index(True), same.index(True) + sum(same))
    assert place_of(df, by, 3000) is None


def test_a_deep_page_moves_only_itself(spark, tmp_path):
    """The plan sorts what the bounds leave, and they reach the scan."""
    path = str(tmp_path / "t")
    spark.range(0, 200_000, 1, 8).selectExpr("id", "id * 7 % 100003 AS v", "'x' AS more").write.parquet(path)
    df = spark.read.parquet(path)
    page = rows_between(df, [By("v", True), By("id")], 24, 100_000)
    plan = plan_of(page)
    assert "limit=24," in plan.replace(" ", "") or "TakeOrderedAndProject(limit=24" in plan
    assert "LessThanOrEqual(v," in plan
    assert [r.id for r in page.collect()] == [r.id for r in df.orderBy(F.desc("v"), "id").offset(100_000).limit(24).collect()]
    batch = rows_between(df, [By("v"), By("id")], 50_000)
    assert "TakeOrdered" not in plan_of(batch) and "Limit" not in plan_of(batch).split("== Physical Plan ==")[1]
    assert batch.count() == 50_000


def test_ids_continue_after_the_last_one(spark):
    rows = spark.createDataFrame([("c",), ("a",), ("b",)], "k string")
    got = assign_ids(rows, [F.col("k").asc()], last_id=41)
    assert {r.k: r.id for r in got.collect()} == {"a": 42, "b": 43, "c": 44}


def test_pending_batch_order_and_rotation(spark):
    rows = [("a", "k", 0), ("b", None, 5), ("c", None, 0), ("d", None, 1)]
    t = spark.createDataFrame(rows, "id string, s3_key string, tries int")
    assert [r.id for r in pending_batch(t, 2, ["id"], "id").collect()] == ["b", "c"]
    rotated = pending_batch(t, 2, ["id"], "id", order_by=[F.col("tries").asc()])
    assert [r.id for r in rotated.collect()] == ["c", "d"]
    assert tuple(backlog(t).first()) == (4, 3)
    assert tuple(backlog(t.limit(0)).first()) == (0, 0)


def test_pending_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "k", "x")], "id string, s3_key string, other string").write.parquet(path)
    plan = plan_of(pending_batch(spark.read.parquet(path), 2, ["id"], "id"))
    assert "IsNull(s3_key)" in plan and "ReadSchema: struct<id:string,s3_key:string>" in plan


def test_search(spark):
    rows = [(i, "Red Fox" if i % 2 else "owl", "sfw" if i % 5 else "nsfw", i // 3) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, title string, purity string, added int")
    hits = sorted(
        (r for r in rows if "fox" in r[1].lower() and r[2] == "sfw"), key=lambda r: (-r[3], r[0])
    )
    args = dict(query="FOX", text="title", purity="sfw", purity_col="purity", added="added", key="id", size=5)
    for page in (1, 2, 3, 4):
        got = [r.id for r in search_page(df, page=page, **args).collect()]
        assert got == [r[0] for r in hits[(page - 1) * 5 : page * 5]]
    with pytest.raises(ValueError):
        search_page(df, page=0, **args)
