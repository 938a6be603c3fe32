"""Newest-first search with paging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import By, rows_between

DEEP_PAGE = 1_000  # hits before which a page is found without counting


def search_page(
    df: DataFrame,
    *,
    query: str,
    text: str,
    purity: str,
    purity_col: str,
    added: str,
    key: str,
    page: int = 1,
    size: int = 24,
) -> DataFrame:
    """Page ``page`` (from 1) of the rows that match, newest first, the key breaking ties.

    A deep page is found by counts (``rows_between``): the hits before it are not moved.
    """
    if page < 1:
        raise ValueError("pages are counted from 1")
    hits = df.where(
        (F.col(purity_col) == purity)
        & F.contains(F.lower(F.col(text)), F.lit(query.lower()))
    )
    return rows_between(hits, [By(added, descending=True), By(key)], size, (page - 1) * size, deep=DEEP_PAGE)
