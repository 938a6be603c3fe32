"""What the operators share: texts as batches, tables that cut lineage, small constant tables."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import new_folder

# Texts of one step of a Python worker: it stops collecting at this many characters.
SLICE_CHARS = 2_000_000

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; ``TOKENIZER_DIR`` names another folder."""
    return os.path.join(TOKENIZERS, name)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table below the shared work folder and read it back.

    Lost executors do not take it along, later reads do not compute it again, and a join with it
    shuffles both sides, so that AQE may split a skewed key.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def constant_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table of literals, without an RDD. Callers state the bound of ``rows``."""
    literal = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(literal))


def slices(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of a batch of some ``SLICE_CHARS`` characters each, one text at least."""
    start = chars = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and chars + n > SLICE_CHARS:
            yield start, i
            start, chars = i, 0
        chars += n
    if start < len(texts):
        yield start, len(texts)


def text_udf(work: Callable[[list[str]], pd.DataFrame], schema: StructType | str) -> Callable[[Column], Column]:
    """``work`` as a column function from text to a struct. NULL counts as the empty text.

    ``work`` gets whole texts, a slice at a time, and returns one row per text. The function is
    marked non-deterministic only so that a filter on its result does not run it twice.
    """

    def batches(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in series:
            texts = s.tolist()
            done = [
                work([t if isinstance(t, str) else "" for t in texts[a:b]]) for a, b in slices(texts)
            ]
            yield pd.concat(done, ignore_index=True) if done else work([])

    batches.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(batches, schema).asNondeterministic()


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5: fold 0 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))
