"""Tables and manifests bucketed by their key: a join moves the other side only."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.test_log import Table
from tidemark.functions.coerce import run_timestamp
from tidemark.operators.reconcile import reconcile
from tidemark.operators.upsert import upsert
from tidemark.schemas import WALLPAPERS
from tidemark.sources import buckets
from tidemark.sources.buckets import read_bucketed, write_bucketed
from tidemark.sources.tables import (
    clean,
    count_pending,
    ensure_table,
    merge,
    merged_ops,
    read_pending,
    read_table,
)

SPEC = dataclasses.replace(WALLPAPERS, buckets=8)
ITEM = "wallhaven_id string, url string, resolution string, category string, purity string, file_size bigint"


def _batch(spark, keys, size=1):
    return spark.createDataFrame([(k, f"u/{k}", None, None, None, size) for k in keys], ITEM)


def _merge(spark, path, run, keys, size=1, **more):
    return merge(spark, path, SPEC, run, _batch(spark, keys, size), lambda t, b: upsert(t, b, SPEC, run_timestamp("2024-01-02")), **more)


def _forget(spark, path):
    """As a new session would find the table."""
    for name in os.listdir(path):
        buckets.forget(spark, f"{path}/{name}")


@pytest.fixture
def exact(spark):
    """No broadcast by chance: what is moved is what the layout asks for."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_merge_moves_only_the_batch(spark, tmp_path, exact):
    path, keys = str(tmp_path / "t"), [f"k{i}" for i in range(200)]
    ensure_table(spark, path, SPEC)
    _merge(spark, path, "r1", keys)
    plans = []
    for run, size in (("r2", 2), ("r3", 3)):
        now = run_timestamp("2024-01-02")
        resolve = lambda t, b: (plans.append(plan_of(out := upsert(t, b, SPEC, now))), out)[1]
        merge(spark, path, SPEC, run, _batch(spark, [*keys[:50], f"new{run}"], size), resolve, check=run == "r3")
        _forget(spark, path)
    for plan in plans:
        physical = plan.split("== Physical Plan ==")[1]
        assert physical.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in physical
    assert tuple(merged_ops(spark, path, "r3").first()) == (1, 50, 151, 0)
    rows = {r.wallhaven_id: r.file_size for r in read_table(spark, path, SPEC).collect()}
    assert len(rows) == 202 and rows["k0"] == 3 and rows["k99"] == 1


def test_versions_with_buckets_are_whole_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    ensure_table(spark, path, SPEC)
    assert read_table(spark, path, SPEC).count() == 0
    for i in range(4):
        _merge(spark, path, f"r{i}", [f"k{j}" for j in range(10 * (i + 1))], size=i)
    _forget(spark, path)
    assert count_pending(spark, path, SPEC).first()[0] == read_pending(spark, path, SPEC).count() == 40
    assert clean(spark, path, keep=2) >= 2 and read_table(spark, path, SPEC).count() == 40
    # one file for each bucket and kind of row, though nothing was dealt out anew
    latest = sorted(n for n in os.listdir(path) if n.startswith("v"))[-1]
    assert len([f for f in os.listdir(f"{path}/{latest}/pending=true") if f.endswith(".parquet")]) <= 8


def test_publishing_from_a_bucketed_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tests.test_log.SPEC", SPEC)
    table = Table(spark, str(tmp_path))
    table.load("l1", "abcd")
    table.stage(*"ab")
    assert table.publish("p1")[0] == 2 and table.waiting() == ["c", "d"]
    table.load("l2", "de", day=3)
    assert {k: v[0] for k, v in table.rows().items()} == {"a": "wallpapers/a.jpg", "b": "wallpapers/b.jpg", "c": None, "d": None, "e": None}


def test_a_bucketed_manifest_stays_where_it_is(spark, tmp_path, exact):
    folder = str(tmp_path / "it's a manifest")
    manifest = spark.range(0, 3000, 2).select(F.concat(F.lit("k"), "id").alias("s3_key"), F.lit(1).alias("size"))
    write_bucketed(manifest.unionByName(manifest), folder, ["s3_key"], 8)
    buckets.forget(spark, folder)
    there = read_bucketed(spark, folder, manifest.schema, ["s3_key"], 8)
    rows = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("s3_key"), "id")
    got = reconcile(rows, there, "s3_key")
    assert plan_of(got).split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
    assert got.where("object_exists").agg(F.count("*"), F.sum(F.col("id") % 2)).first() == (1500, 0)
