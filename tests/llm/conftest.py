"""Small tables of difficult texts, and the same read from disk."""

from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.01"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the quick brown fox jumps over the lazy dog while seven small wizards watch from behind an old oak".split()


def long_text(n: int) -> str:
    return " ".join(f"{WORDS[i % len(WORDS)]}{i % 97}" for i in range(n))


# NULLs in every column, empty and wordless texts, ties, repeated rows, a long text without a break.
ROWS = [
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, " \n\t ", "en", None, 4),
    (4, long_text(30), "en", "a", 1),
    (5, long_text(30), "en", "a", 1),
    (5, long_text(30), "en", "a", 1),
    (None, long_text(30), "en", "a", 1),
    (None, None, None, None, None),
    (6, "x" * 30_000, "en", "b", 1),
    (7, long_text(9_000), "en", "b", 1),
    (8, "Ünïcödé ΣΑΣ İ 😀 日本語 é \x1c\x85 \x00", "de", "b", 1),
    (9, "two words", "en", "b", 9),
    (-3, "a<|endoftext|>b\nReleased under the MIT License.", "en", "b", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
