import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.coerce import run_timestamp
from tidemark.operators.dedupe import dedupe_last, first_n
from tidemark.operators.upsert import fits_broadcast, load_metrics, merge_statement, op_counts, upsert
from tidemark.operators.validate import flag_valid
from tidemark.schemas import WALLPAPERS, WALLPAPERS_SCHEMA
from tests.conftest import plan_of

OLD, NOW = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
ITEM = "wallhaven_id string, url string, resolution string, category string, purity string, file_size bigint"


def run():
    return run_timestamp("2024-01-02 00:00:00")


@pytest.fixture(scope="module")
def target(spark):
    rows = [
        ("a", "u1", "1x1", "c", "p", 10, "k1", OLD, OLD),
        ("b", "u2", "1x1", "c", "p", 20, None, OLD, None),
    ]
    return spark.createDataFrame(rows, WALLPAPERS_SCHEMA)


def _batch(spark, *rows):
    return spark.createDataFrame([(k, u, None, None, None, s) for k, u, s in rows], ITEM)


def _by_key(df):
    return {r.wallhaven_id: r for r in df.collect()}


@pytest.mark.parametrize("small", [False, True])
def test_insert_update_keep(spark, target, small):
    batch = _batch(spark, ("b", "u2n", None), ("c", "u3", 5))
    out = upsert(target, batch, WALLPAPERS, run(), broadcast_batch=small)
    assert out.columns == [*WALLPAPERS.columns, "op"]
    got = _by_key(out)
    view = {k: (r.op, r.url, r.file_size, r.s3_key, r.created_at, r.updated_at) for k, r in got.items()}
    assert view == {
        "a": ("keep", "u1", 10, "k1", OLD, OLD),
        "b": ("update", "u2n", None, None, OLD, NOW),
        "c": ("insert", "u3", 5, None, NOW, None),
    }
    assert got["b"].category is None  # an incoming NULL overwrites
    assert {r.op: r.n for r in op_counts(out).collect()} == {"keep": 1, "update": 1, "insert": 1}


@pytest.mark.parametrize("small", [False, True])
def test_published_rows_keep_their_object_key(spark, target, small):
    got = _by_key(upsert(target, _batch(spark, ("a", "changed", 1)), WALLPAPERS, run(), broadcast_batch=small))
    assert (got["a"].url, got["a"].s3_key, got["a"].op) == ("changed", "k1", "update")


def test_an_equal_batch_still_counts_as_update(spark, target):
    same = target.select(*WALLPAPERS.keys, *WALLPAPERS.update_cols)
    got = _by_key(upsert(target, same, WALLPAPERS, run()))
    assert {r.op for r in got.values()} == {"update"}
    assert {r.updated_at for r in got.values()} == {NOW}


def test_empty_batch_keeps_everything(spark, target):
    for small in (False, True):
        got = upsert(target, _batch(spark).limit(0), WALLPAPERS, run(), broadcast_batch=small)
        assert {r.op for r in got.collect()} == {"keep"}


def test_a_small_batch_does_not_shuffle_the_target(spark, target, tmp_path):
    path = str(tmp_path / "t")
    target.write.parquet(path)
    big = spark.read.parquet(path)
    # the target's exchange would be there if the planner were not told that the batch is small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = _batch(spark, ("b", "x", 1))
        assert "Exchange hashpartitioning" not in plan_of(upsert(big, batch, WALLPAPERS, run(), broadcast_batch=True))
        assert "Exchange hashpartitioning" in plan_of(upsert(big, batch, WALLPAPERS, run()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_bounds():
    assert fits_broadcast(10, 1000)
    assert not fits_broadcast(10**9, 1000) and not fits_broadcast(10, 10**12)


def test_last_position_wins(spark):
    df = spark.createDataFrame([("b", 1, "x"), ("b", 3, "z"), ("b", 2, "y"), ("c", 0, "c")], "k string, pos int, v string")
    assert {r.k: r.v for r in dedupe_last(df, ["k"], ["pos"]).collect()} == {"b": "z", "c": "c"}


def test_strict_raises_on_a_repeated_key(spark):
    df = spark.createDataFrame([("b", 1), ("c", 2)], "k string, pos int")
    assert dedupe_last(df, ["k"], ["pos"], strict=True).count() == 2
    with pytest.raises(Exception, match="repeated key in batch: b"):
        dedupe_last(df.union(df.where("k = 'b'")), ["k"], ["pos"], strict=True).collect()


def test_first_n_per_group(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    got = first_n(df, ["g"], [F.col("v").desc()], 2)
    assert sorted((r.g, r.pos, r.v) for r in got.collect()) == [
        (0, 1, 99), (0, 2, 96), (1, 1, 97), (1, 2, 94), (2, 1, 98), (2, 2, 95),
    ]


def test_dedupe_trims_hot_keys_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(dedupe_last(df, ["k"], ["id"]))
    final, partial = plan.index("Final"), plan.index("row_number(), 1, Partial")
    exchange = plan.index("Exchange hashpartitioning")
    assert final < exchange < partial


def test_load_metrics(spark):
    items = spark.createDataFrame(
        [("a", "u"), ("a", "u2"), ("b", "u"), (None, "u"), ("c", ""), ("d", "u")], "id string, url string"
    )
    known = spark.createDataFrame([("a",), ("x",), ("a",)], "id string")
    got = load_metrics(flag_valid(items, "id", "url"), known, ["id"]).first().asDict()
    assert got == {"extracted": 6, "invalid": 2, "duplicates": 1, "inserted": 2, "updated": 1}
    none = load_metrics(flag_valid(items.limit(0), "id", "url"), known, ["id"]).first()
    assert tuple(none) == (0, 0, 0, 0, 0)
    bad = load_metrics(flag_valid(items.where("url = ''"), "id", "url"), known, ["id"]).first()
    assert tuple(bad) == (1, 1, 0, 0, 0)


def test_merge_statement_is_accepted_by_the_parser(spark):
    text = merge_statement("db.wallpapers", "batch", WALLPAPERS)
    spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    assert "t.wallhaven_id = s.wallhaven_id" in text and "s3_key" not in text


deliveries = st.lists(
    st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 9)), max_size=6), min_size=1, max_size=3
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(deliveries)
def test_upserts_match_a_plain_dictionary(spark, runs):
    table = spark.createDataFrame([], WALLPAPERS_SCHEMA)
    model = {}
    for i, rows in enumerate(runs):
        batch = spark.createDataFrame(
            [(k, f"u{v}", None, None, None, v, pos) for pos, (k, v) in enumerate(rows)], ITEM + ", pos int"
        )
        out = upsert(table, dedupe_last(batch, ["wallhaven_id"], ["pos"]), WALLPAPERS, run(), broadcast_batch=i % 2 == 1)
        ops = {r.wallhaven_id: r.op for r in out.collect()}
        last = dict(rows)
        want = {k: "keep" for k in model}
        want.update({k: "update" if k in model else "insert" for k in last})
        assert ops == want
        model.update(last)
        kept = out.drop("op").collect()
        assert {r.wallhaven_id: r.file_size for r in kept} == model
        table = spark.createDataFrame(kept, WALLPAPERS_SCHEMA)
