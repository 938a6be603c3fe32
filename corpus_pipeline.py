"""Documents to packed training sequences: quality, toxicity, near duplicates, packing.

Each stage reads the table that the one before wrote. Models are fitted on the labelled documents of
the same folder, outside the held-out fold.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import packing, quality, simhash, toxicity
from tidemark.llm.queries import table
from tidemark.session import work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def clean_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_text),
    ("toxicity", clean_text),
    ("SimHash near-dedup", one_of_each_group),
    ("best-fit packing", sequences),
]

# Every stage but the packing decides by a trained model or by a hash that SQL does not have, and the
# packing by a tokenizer; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below the shared work folder."""
    folder = f"{work_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
