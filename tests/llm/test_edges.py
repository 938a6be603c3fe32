"""Every operator on difficult rows, on an empty table, and beside columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import ROWS
from tidemark.llm import bpe, fingerprints, lexical, license_scan, lm_score, neighbours, packing, periodic, quality, repeats, sharding, simhash, toxicity

LABELS = [(i, i % 2, (i + 1) % 2) for i in range(1, 10)] + [(None, 1, 1), (1, None, None), (2, 1, 0)]


@pytest.fixture(scope="module")
def odd_labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


OPERATORS = {
    "license": lambda d, lab: license_scan.scan_documents(d),
    "bpe": lambda d, lab: bpe.round_trip(d),
    "quality": lambda d, lab: d.select("doc_id", quality.quality(F.col("text"), quality.train(d, lab)).alias("q")),
    "simhash": lambda d, lab: simhash.near_groups(d),
    "packing": lambda d, lab: packing.packed_pieces(d),
    "lm": lambda d, lab: lm_score.score(d),
    "fingerprints": lambda d, lab: fingerprints.compare_with_next(d),
    "sharding": lambda d, lab: sharding.shard_documents(d),
    "repeats": lambda d, lab: repeats.remove_repeats(d),
    "periodic": lambda d, lab: periodic.periodic_runs(d),
    "toxicity": lambda d, lab: d.select("doc_id", toxicity.toxicity(F.col("text"), toxicity.train(d, lab)).alias("t")),
}


def result(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_difficult_rows(spark, odd, odd_labels, name):
    clashing = ["_r", "_s", "_q", "_p", "_t", "_lane", "_rank", "_own", "_range", "bits", "node", "score", "spans", "point", "length", "task", "key", "note", "anchor", "_whole"]
    rows = result(OPERATORS[name](odd, odd_labels))
    if name == "packing":
        assert sum(" piece=0," in r for r in rows) == len(ROWS)
    else:
        assert len(rows) == len(ROWS)
    more = odd.withColumns({c: F.lit(7) for c in clashing})
    got = result(OPERATORS[name](more, odd_labels))
    assert got == rows or name == "lm" and len(got) == len(rows)  # sums of weights are in any order


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(empty, odd_labels, name):
    assert result(OPERATORS[name](empty, odd_labels.limit(0))) == []


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:3], ids=lambda s: s[0])
def test_stages_keep_columns(spark, odd, empty, stage):
    more = odd.withColumns({"row": F.lit(1), "quality": F.lit(2), "toxicity": F.lit(3), "component_id": F.lit(4)})
    out = stage[1](spark, more, "/root/testdata/sf0.01")
    assert out.schema == more.schema
    assert 0 < out.count() <= len(ROWS)
    assert stage[1](spark, empty, "/root/testdata/sf0.01").count() == 0


def test_last_stage_on_difficult_rows(spark, odd, empty):
    pack = corpus_pipeline.STAGES[-1][1]
    more = odd.withColumns({c: F.lit(7) for c in ("piece", "length", "ids", "sequence_id", "offset", "first", "low")})
    rows = pack(spark, more, "/root/testdata/sf0.01").toPandas()
    assert (rows["piece"] == 0).sum() == len(ROWS)
    assert (rows.groupby("sequence_id")["length"].sum() <= packing.CAPACITY).all()
    assert pack(spark, empty, "/root/testdata/sf0.01").count() == 0


def test_search_beside_clashing_columns(spark, odd, empty):
    items = spark.createDataFrame([(1, "the Quick brown"), (2, None), (None, "words")], "item_id long, text string")
    rows = result(lexical.search(odd, items))
    assert rows and result(lexical.search(empty, items)) == [] and result(lexical.search(odd, items.limit(0))) == []
    clashing = {c: F.lit(7) for c in ("term", "terms", "tfs", "n", "score", "rank", "_lane")}
    assert result(lexical.search(odd.withColumns(clashing), items.withColumns(clashing))) == rows


def test_labels_of_one_kind_give_the_share(spark, odd):
    one = spark.createDataFrame([(i, 1, 0) for i in range(1, 10)], "doc_id long, quality int, toxic int")
    scored = odd.select(quality.quality(F.col("text"), quality.train(odd, one))["score"].alias("s")).distinct().collect()
    assert len(scored) == 1 and scored[0]["s"] > 0.5
    scored = odd.select(toxicity.toxicity(F.col("text"), toxicity.train(odd, one))["score"].alias("s")).distinct().collect()
    assert len(scored) == 1 and scored[0]["s"] < 0.5


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (2, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"v": F.lit(1), "t": F.lit(2), "query": F.lit(3)})
    got = neighbours.nearest(neighbours.usable(frame), F.col("vec_id") <= 2, k=10).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3)]
    assert neighbours.nearest(neighbours.usable(frame.limit(0)), F.col("vec_id") <= 2).count() == 0
