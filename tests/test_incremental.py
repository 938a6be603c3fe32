import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.coerce import run_timestamp
from tidemark.plans.publish import publish_run
from tidemark.schemas import RUN_AUDIT, WALLPAPERS
from tidemark.sources.landing import ARRIVAL, extract_items, stream_pages
from tidemark.sources.tables import read_table
from tidemark.streaming.incremental import incremental_run

SPEC = WALLPAPERS


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, str(root), 0
        os.makedirs(f"{self.root}/landing")

    def land(self, *ids):
        self.n += 1
        items = [{"id": i, "path": f"https://x/{i}.jpg", "file_size": self.n} for i in ids]
        with open(f"{self.root}/landing/{self.n}.json", "w") as f:
            json.dump({"data": items}, f)

    def run(self, name, publish=None, **source):
        pages = stream_pages(self.spark, f"{self.root}/landing", **source)
        r = incremental_run(
            pages, SPEC, f"{self.root}/table", f"{self.root}/audit", f"{self.root}/state", "dag", name,
            F.lit("2024-01-01").cast("timestamp"), run_timestamp("2024-01-01 00:01:00"),
            ARRIVAL, "wallhaven_id", "url", prepare=extract_items, publish=publish,
        ).first()
        return r.metadata_inserted, r.metadata_updated, r.missing_s3_after_run

    def sizes(self):
        return {r.wallhaven_id: r.file_size for r in read_table(self.spark, f"{self.root}/table", SPEC).collect()}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_each_run_takes_what_is_new(spark, feed):
    assert feed.run("r0") == (0, 0, 0)
    feed.land("a", "b")
    assert feed.run("r1") == (2, 0, 2)
    feed.land("b", "c")
    feed.land("d", "")
    assert feed.run("r2") == (2, 1, 4)
    assert feed.run("r3") == (0, 0, 4)
    assert feed.sizes() == {"a": 1, "b": 2, "c": 2, "d": 3}
    runs = {r.run_id for r in read_table(spark, f"{feed.root}/audit", RUN_AUDIT).collect()}
    assert runs == {"r0", "r1", "r2", "r3"}


def test_a_run_may_take_several_micro_batches(feed):
    for ids in ("ab", "bc", "cd"):
        feed.land(*ids)
    assert feed.run("r1", maxFilesPerTrigger="1") == (4, 2, 4)


def test_a_micro_batch_delivered_twice_counts_once(spark, feed, monkeypatch):
    feed.land("a", "b")
    import tidemark.streaming.incremental as module

    real = module.load_run

    def dies_after_loading(*args, **kwargs):
        real(*args, **kwargs).collect()
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(module, "load_run", dies_after_loading)
        with pytest.raises(Exception):
            feed.run("r1")
    assert set(feed.sizes()) == {"a", "b"}
    assert feed.run("r1") == (2, 0, 2)


def test_a_run_that_failed_before_its_record_is_recorded_in_full(feed, monkeypatch):
    feed.land("a", "b")
    with monkeypatch.context() as m:
        m.setattr("tidemark.streaming.incremental.audit_run", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feed.run("r1")
    assert feed.run("r1") == (2, 0, 2)


def test_a_run_publishes_what_it_has_loaded(spark, feed):
    os.makedirs(f"{feed.root}/contents/x")
    for name in "ab":
        with open(f"{feed.root}/contents/x/{name}.jpg", "w") as f:
            f.write(name)

    def publish():
        return publish_run(
            f"{feed.root}/table", f"{feed.root}/contents", f"{feed.root}/objects", "p1",
            run_timestamp("2024-01-01 00:01:00"), spec=SPEC, wait_s=0.0, spark=spark,
        )

    feed.land("a", "b", "c")
    assert feed.run("r1", publish) == (3, 0, 1)
    record = read_table(spark, f"{feed.root}/audit", RUN_AUDIT).first()
    assert (record.images_uploaded, record.download_failures) == (2, 1)
