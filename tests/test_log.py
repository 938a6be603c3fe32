"""Publishing as a log beside the table: nothing is rewritten, loads take it in, and it does not grow."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.coerce import run_timestamp
from tidemark.operators.upsert import upsert
from tidemark.plans.publish import publish_run
from tidemark.schemas import WALLPAPERS
from tidemark.sources import log
from tidemark.sources.tables import (
    clean,
    count_pending,
    current_version,
    ensure_table,
    merge,
    read_pending,
    read_table,
    register,
)

SPEC = WALLPAPERS
ITEM = "wallhaven_id string, url string, resolution string, category string, purity string, file_size bigint"


def at(day):
    return run_timestamp(f"2024-01-{day:02d} 00:00:00")


class Table:
    def __init__(self, spark, root):
        self.spark, self.path = spark, f"{root}/table"
        self.contents, self.objects = f"{root}/contents", f"{root}/objects"
        os.makedirs(f"{self.contents}/x")
        ensure_table(spark, self.path, SPEC)

    def load(self, run, keys, day=1):
        batch = self.spark.createDataFrame([(k, f"https://x/{k}.jpg", None, None, None, day) for k in keys], ITEM)
        merge(self.spark, self.path, SPEC, run, batch, lambda t, b: upsert(t, b, SPEC, at(day)))

    def stage(self, *keys):
        for k in keys:
            with open(f"{self.contents}/x/{k}.jpg", "w") as f:
                f.write(k)

    def publish(self, run, day=2, limit=100):
        got = publish_run(self.path, self.contents, self.objects, run, at(day), limit, spark=self.spark, wait_s=0.0)
        return tuple(got.first())

    def append(self, run, outcomes, day=2):
        rows = [(k, f"o/{k}", o, "", 1, 1) for k, o in outcomes.items()]
        frame = self.spark.createDataFrame(rows, "wallhaven_id string, s3_key string, outcome string, content_type string, attempts long, bytes long")
        log.append(self.spark, self.path, SPEC, run, frame, at(day))

    def files(self):
        version = current_version(self.spark, self.path).folder
        return sorted(f"{d}/{f}" for d, _, names in os.walk(version) for f in names)

    def rows(self):
        return {r.wallhaven_id: (r.s3_key, r.file_size, r.updated_at and r.updated_at.day) for r in read_table(self.spark, self.path, SPEC).collect()}

    def waiting(self):
        pending = sorted(r.wallhaven_id for r in read_pending(self.spark, self.path, SPEC).collect())
        assert count_pending(self.spark, self.path, SPEC).first()[0] == len(pending)
        return pending


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path))


def test_a_publish_writes_no_table_file(spark, table):
    table.load("l1", "abcdefgh")
    before = table.files()
    table.stage(*"abcdef")
    assert table.publish("p1", limit=5) == (5, 0, 0)
    assert table.files() == before
    assert table.rows() == {k: (f"wallpapers/{k}.jpg" if k < "f" else None, 1, 2 if k < "f" else None) for k in "abcdefgh"}
    assert table.waiting() == ["f", "g", "h"]
    register(spark, "t_log", table.path, SPEC)
    assert spark.sql("SELECT count(*) FROM t_log WHERE s3_key IS NULL").first()[0] == 3


def test_the_next_load_takes_the_log_in(table):
    table.load("l1", "abc")
    table.stage(*"ab")
    table.publish("p1")
    table.load("l2", "bd", day=3)
    assert current_version(table.spark, table.path).taken == 1
    expected = {"a": ("wallpapers/a.jpg", 1, 2), "b": ("wallpapers/b.jpg", 3, 3), "c": (None, 1, None), "d": (None, 3, None)}
    assert table.rows() == expected and table.waiting() == ["c", "d"]
    # a published row is in a file of published rows now: nothing is left to join
    assert log.published(table.spark, log.current_log(table.spark, table.path), SPEC, 1) is None
    table.stage("d")
    table.publish("p2", day=4)
    assert table.rows()["d"] == ("wallpapers/d.jpg", 3, 4) and table.waiting() == ["c"]


def test_a_reader_of_before_stays_with_what_it_read(table):
    table.load("l1", "ab")
    held = read_table(table.spark, table.path, SPEC)
    table.stage(*"ab")
    table.publish("p1")
    assert held.where("s3_key IS NOT NULL").count() == 0 and table.waiting() == []


def test_an_unfinished_run_of_the_log_does_not_count(table):
    table.load("l1", "ab")
    table.append("p1", {"a": "uploaded"})
    os.remove(f"{log.folder_of(table.spark, table.path, 'p1')}/_SUCCESS")
    assert table.waiting() == ["a", "b"]
    table.stage(*"ab")
    assert table.publish("p1") == (2, 0, 0) and table.waiting() == []


def test_files_read_do_not_grow_with_the_number_of_runs(spark, table):
    """Fifty publish runs, no load in between: most of them fail for some keys."""
    keys = [f"k{i:02d}" for i in range(60)]
    table.load("l1", keys)
    failed = dict.fromkeys(keys, 0)
    folders, sizes = [], []
    for i in range(50):
        outcomes = {keys[i]: "uploaded", **{k: "download_failure" for k in keys[i + 1 : i + 4]}}
        for k in keys[i + 1 : i + 4]:
            failed[k] += 1
        table.append(f"p{i}", outcomes, day=1 + i % 28)
        log.fold(spark, table.path, SPEC, taken=0)
        now = log.current_log(spark, table.path)
        folders.append(len(now.runs) + (now.folded is not None))
        sizes.append(log._by_key(spark, now, SPEC).count())
    assert max(folders) <= log.FOLD_AFTER and now.last == 50
    tries = {r.wallhaven_id: r.failed for r in log.attempts(spark, table.path, SPEC).collect()}
    assert tries == {k: n for k, n in failed.items() if n and k >= "k50"}
    assert table.waiting() == keys[50:] and sizes[-1] == 53
    # once a load has taken the keys in, only those that still wait are kept
    table.load("l2", ["new"], day=3)
    log.fold(spark, table.path, SPEC, taken=50, least=0)
    assert log._by_key(spark, log.current_log(spark, table.path), SPEC).count() == 3
    assert table.waiting() == [*keys[50:], "new"]


def test_failed_rows_are_tried_again_while_new_ones_arrive(table):
    """Two rows fail on the first day; two new ones come every day, and a run takes two."""
    table.load("l1", ["a1", "a2"], day=1)
    assert table.publish("p1", day=1, limit=2) == (0, 2, 0)
    table.stage("a1", "a2")
    for day in (2, 3, 4):
        fresh = [f"d{day}x", f"d{day}y"]
        table.stage(*fresh)
        table.load(f"l{day}", fresh, day=day)
        assert table.publish(f"p{day}", day=day, limit=2) == (2, 0, 0)
        if day == 3:
            assert all(table.rows()[k][0] for k in ("a1", "a2"))


def test_rows_that_never_succeed_take_an_ever_smaller_share(table):
    bad, good = [f"a{i}" for i in range(4)], []
    table.load("l0", bad, day=1)
    tried = []
    for day in range(1, 7):
        good += [f"n{day:02d}"]
        table.stage(good[-1])
        table.load(f"l{day}", good[-1:], day=day)
        tried.append(table.publish(f"p{day}", day=day, limit=2)[1])
    assert sum(tried[:3]) > sum(tried[3:]) > 0  # less and less, never none
    left = set(table.waiting())
    assert set(bad) <= left and len(left - set(bad)) <= 3


def test_runs_can_be_cleaned(table):
    for day in range(1, 10):
        table.load(f"l{day}", [f"k{day}"], day=day)
        table.stage(f"k{day}")
        table.publish(f"p{day}", day=day)
        clean(table.spark, table.path, keep=2)
    names = os.listdir(table.path)
    assert sum(n.startswith("v0") for n in names) == 2
    assert len(os.listdir(f"{table.path}/log")) <= log.FOLD_AFTER + 2 and len(os.listdir(f"{table.path}/folded")) == 1
    assert table.waiting() == [] and len(table.rows()) == 9
    assert table.publish("p9", day=11) == (1, 0, 0)  # the last run can still be resumed


def test_due_follows_failures(spark):
    from tidemark.operators.reconcile import due_at

    rows = [(1, None, None), (1, 1, 5), (1, 2, 5), (1, 3, 5), (1, 99, 5)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, "c int, failed long, t int")
        day = lambda n: (F.lit(f"2024-01-0{n} 00:00:00")).cast(kind)
        due = due_at(day(1), F.col("failed"), F.when(F.col("t").isNotNull(), day(5)), 3600)
        got = [r[0] for r in df.select(F.timestamp_diff("HOUR", day(1), due)).collect()]
        assert got == [0, 97, 98, 100, 96 + 64]
