import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import (
    content_type,
    is_retryable,
    object_key,
    payload_size,
    probe_class,
    url_extension,
)

EXTENSIONS = {
    "https://w.x.cc/full/9m/w-9mkxdd.JPG": "jpg",
    "https://x.com/a.png?v=1": "png",
    "https://x.com/a.png?v=1.2": "2",
    "https://x.com/path": "com/path",
    "nodots": "jpg",
    "nodots?q": "jpg",
    "a.": "",
    "a.JPEG#f": "jpeg#f",
    "a.?x": "",
    " ": "jpg",
}

STRICT = {
    "https://w.x.cc/full/9m/w-9mkxdd.JPG": "jpg",
    "https://x.com/a.png?v=1.2": "png",
    "https://x.com/path": "jpg",
    "https://x.com": "jpg",
    "a.JPEG#f": "jpeg",
    "a.": "jpg",
    "http://h.org/d.ir/name": "jpg",
}


def _map(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return {r[0]: r[1] for r in df.select("x", expr(F.col("x"))).collect()}


def test_extension_is_the_text_after_the_last_dot(spark):
    assert _map(spark, EXTENSIONS, url_extension) == EXTENSIONS


def test_strict_extension_looks_at_the_path_only(spark):
    assert _map(spark, STRICT, lambda c: url_extension(c, strict=True)) == STRICT


def test_object_key(spark):
    df = spark.createDataFrame([("a1", "https://x/y.PNG?z"), ("b", "nodots")], "id string, url string")
    keys = [r[0] for r in df.select(object_key(F.col("id"), F.col("url"))).collect()]
    assert keys == ["wallpapers/a1.png", "wallpapers/b.jpg"]
    other = df.select(object_key(F.col("id"), F.col("url"), prefix="p")).first()[0]
    assert other == "p/a1.png"


def test_content_type(spark):
    expected = {
        "p/a.PNG": "image/png",
        "p/a.webp": "image/webp",
        "p/a.jpeg": "image/jpeg",
        "p/a.JPG": "image/jpeg",
        "p/a.gif": "application/octet-stream",
        "p/a": "application/octet-stream",
        "p/a.png?x": "application/octet-stream",
    }
    assert _map(spark, expected, content_type) == expected


def test_probe_class(spark):
    expected = {"404": "missing", "NoSuchKey": "missing", "NotFound": "missing", "403": "unknown", "": "unknown"}
    assert _map(spark, expected, probe_class) == expected


@pytest.mark.parametrize("status,retry", [(429, True), (500, True), (502, True), (503, True), (504, True), (501, False), (404, False), (200, False)])
def test_retryable(spark, status, retry):
    assert spark.range(1).select(is_retryable(F.lit(status))).first()[0] is retry


def test_payload_size_counts_bytes(spark):
    df = spark.createDataFrame([("é", b"abc")], "s string, b binary")
    assert tuple(df.select(payload_size(F.col("s")), payload_size(F.col("b"))).first()) == (2, 3)
