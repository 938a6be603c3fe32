import pytest

from tidemark.operators import validate
from tidemark.operators.validate import Check, constraint_report, duplicate_keys, enforce, flag_valid, null_rows, valid_rows
from tidemark.sources.folders import input_bytes

ROWS = [("a", "u"), (None, "u"), ("", "u"), ("a", None), ("a", ""), (" ", "u"), ("a", " ")]


def test_missing_and_empty_are_invalid_blanks_are_not(spark):
    df = spark.createDataFrame(ROWS, "id string, url string")
    flags = [r.valid for r in flag_valid(df, "id", "url").collect()]
    assert flags == [True, False, False, False, False, True, True]
    kept = valid_rows(flag_valid(df, "id", "url"), ["url", "id"])
    assert kept.columns == ["url", "id"] and kept.count() == 3


def test_constraint_report_and_enforcement(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, "y"), (None, "z"), (None, None), (1, "w")], "k int, v string")
    report = constraint_report(Check(df, "t", ["k", "v"], ["k"]))
    got = {(r.check_name, r.column_name): r.violations for r in report.collect()}
    assert got == {("not_null", "k"): 2, ("not_null", "v"): 2, ("unique", "k"): 3}
    with pytest.raises(Exception, match="constraint violated: t"):
        enforce(report).collect()
    assert {tuple(r) for r in null_rows(df, ["k", "v"]).collect()} == {(1, None), (None, "z"), (None, None)}
    assert [tuple(r) for r in duplicate_keys(df.where("k IS NOT NULL"), ["k"]).collect()] == [(1, 3)]
    sound = constraint_report(Check(df.where("k = 2"), "t", ["k", "v"], ["k"]))
    assert [r.violations for r in enforce(sound).collect()] == [0, 0, 0]


def test_report_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int, v string")
    assert [r.violations for r in constraint_report(Check(empty, "t", ["k"], ["k"])).collect()] == [0, 0]


def test_keys_of_a_large_input_are_dealt_out_by_its_size(spark, tmp_path, monkeypatch):
    rows = [(k, k % 3) for k in range(3000)] + [(7, 1)] * 2000 + [(None, 2)] * 1500
    spark.createDataFrame(rows, "k long, v int").repartition(6).write.parquet(str(tmp_path / "a b"))
    df = spark.read.schema("k long, v int").parquet(str(tmp_path / "a b"))
    want = {7: 2001, None: 1500}
    assert {r.k: r.n for r in duplicate_keys(df, ["k"]).collect()} == want  # too small to be dealt
    size = input_bytes(df)
    monkeypatch.setattr(validate, "SHARE", -(-size // 40))
    dealt = duplicate_keys(df, ["k"])
    assert dealt.rdd.getNumPartitions() >= 39  # AQE would make one task of it
    assert {r.k: r.n for r in dealt.collect()} == want
    monkeypatch.setattr(validate, "SHARE", -(-size // 10))
    assert 9 <= duplicate_keys(df, ["k"]).rdd.getNumPartitions() <= 10
    report = constraint_report(Check(df, "t", ["k"], ["k"]), Check(df, "t", [], ["k", "v"]))
    got = {(r.check_name, r.column_name): r.violations for r in report.collect()}
    assert got == {("not_null", "k"): 1500, ("unique", "k"): 2000 + 1499, ("unique", "k,v"): 2000 + 1499}
