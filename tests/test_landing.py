import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe_last
from tidemark.sources.landing import ARRIVAL, extract_items, listed_files, page_metrics, read_pages


def _item(i, **more):
    return {"id": i, "path": f"https://x/{i}.png", "resolution": "1x1", "category": "c", "purity": "sfw", **more}


@pytest.fixture
def landing(tmp_path):
    page = {
        "data": [_item("a", file_size=10), _item("b", file_size="20", uploader="u"), {"path": "only"}, None],
        "meta": {"total": 4},
    }
    (tmp_path / "1.json").write_text(json.dumps(page, indent=2))
    (tmp_path / "2.json").write_text('{"error": "x"}')
    (tmp_path / "3.json").write_text("<html>502</html>")
    (tmp_path / "4.json").write_text("")
    (tmp_path / "5.json").write_text(json.dumps({"data": [_item("z", file_size="7.5")]}))
    return str(tmp_path)


def test_items_of_all_readable_pages(spark, landing):
    items = extract_items(read_pages(spark, landing)).orderBy("page", "pos").collect()
    assert [(r.wallhaven_id, r.url, r.file_size, r.pos) for r in items] == [
        ("a", "https://x/a.png", 10, 0),
        ("b", "https://x/b.png", 20, 1),
        (None, "only", None, 2),
        (None, None, None, 3),
        ("z", "https://x/z.png", None, 0),
    ]


def test_limit_keeps_the_first_items_of_each_page(spark, landing):
    items = extract_items(read_pages(spark, landing), limit=1)
    assert sorted(r[0] for r in items.select("wallhaven_id").collect()) == ["a", "z"]


def test_bad_pages_are_counted_also_empty_ones(spark, landing):
    pages = read_pages(spark, landing)
    assert tuple(page_metrics(pages).first()) == (4, 1, 5, 1, 0)
    assert listed_files(pages) == 5
    assert tuple(page_metrics(pages, listed_files(pages)).first()) == (5, 2, 5, 1, 0)


def test_an_odd_item_costs_its_page_nothing(spark, tmp_path):
    ok, odd = _item("a", file_size=1), {"id": {"deep": 1}, "path": ["p"], "file_size": 7.5, "more": {}}
    for name, data in enumerate([[ok, 5], [ok, None], [ok, odd], [ok, ["q"]], [ok, ok], ["{", True, ok, "{}x"]]):
        (tmp_path / f"{name}.json").write_text(json.dumps({"data": data}))
    (tmp_path / "7.json").write_text(json.dumps({"data": 5}))
    (tmp_path / "8.json").write_text("")
    (tmp_path / "9.json").write_text('{"data": [{"id": "d", "id": "e", "path": "p"}]}')
    pages = read_pages(spark, str(tmp_path))
    assert listed_files(pages) == 9
    rows = extract_items(pages).collect()
    assert sorted(str(r.wallhaven_id) for r in rows) == ["None"] + ["a"] * 7 + ["e", '{"deep":1}']
    assert [r.url for r in rows if r.wallhaven_id == '{"deep":1}'] == ['["p"]']
    # the page whose data is no array, and the empty file
    assert tuple(page_metrics(pages, listed_files(pages)).first()) == (9, 2, 10, 1, 5)
    limited = extract_items(pages, limit=1)
    assert limited.where("wallhaven_id = 'a'").count() == 5


def test_only_bad_pages_give_no_items(spark, tmp_path):
    (tmp_path / "x.json").write_text("<html>")
    pages = read_pages(spark, str(tmp_path))
    assert extract_items(pages).count() == 0
    assert tuple(page_metrics(pages).first()) == (1, 1, 0, 0, 0)


def test_one_page_per_line(spark, tmp_path):
    lines = [json.dumps({"data": [_item(f"k{i}", file_size=i)]}) for i in range(20)] + ["broken"]
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    pages = read_pages(spark, str(tmp_path), lines=True)
    assert extract_items(pages).agg(F.sum("file_size")).first()[0] == sum(range(20))
    assert tuple(page_metrics(pages).first()) == (21, 1, 20, 0, 0)


def test_lines_keep_their_order_when_files_are_split(spark, tmp_path):
    lines = [json.dumps({"data": [_item(f"k{i % 7}", file_size=i)]}) for i in range(500)]
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        pages = read_pages(spark, str(tmp_path), lines=True)
        assert pages.select("block").distinct().count() > 5
        items = extract_items(pages)
        assert [r.file_size for r in items.orderBy(*ARRIVAL).collect()] == list(range(500))
        last = dedupe_last(items, ["wallhaven_id"], ARRIVAL)
        assert {r.file_size for r in last.collect()} == set(range(493, 500))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
