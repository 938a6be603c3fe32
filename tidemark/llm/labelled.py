"""A bounded sample of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_of

_RANGE = 1 << 30


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label) of about ``rows`` labelled documents outside fold 0.

    ``rows`` is the documented bound: a larger label table is thinned by a hash of the id, without
    regard to its order. NULL ids and labels are left out; a repeated label counts once. Only the
    thinned ids are broadcast, so the documents are scanned but not shuffled. A repeated document comes
    repeatedly: callers take distinct rows of what they send to the driver.
    """
    usable = labels.where(
        F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold_of(F.col("doc_id")) != 0)
    ).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    share = min(1.0, rows / max(1, usable.count()))
    place = F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(_RANGE))
    picked = usable.where(place < int(share * _RANGE))
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
