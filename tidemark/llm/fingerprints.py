"""Document fingerprints from closed syncmers.

A run of ``K`` characters is an anchor if the smallest hash among its inner runs of ``S`` characters
lies at its first or last place. Whether a run is chosen depends on that run alone, so an edit changes
only the anchors that overlap it, and equal passages have equal anchors wherever they stand. Of any
``K - S`` runs in a row at least one is chosen in all but degenerate texts.

A fingerprint is all anchors' hashes in order, eight hex digits each. Its likeness to another is the
number of anchors that they share over the number that either has, counting repeats.

Defined results: a text without anchors (shorter than ``K``, mostly) has one anchor, itself; an empty or
NULL text has none. Partial likeness needs a shared run of ``K`` characters that is an anchor: texts shorter
than ``K`` are alike or not as a whole, and of texts whose last third is edited, those below 47 characters
share no run, and those little longer few. Two empty fingerprints have likeness 1, an empty and another one 0.
Characters are code points.

``successors`` gives every document its next one by descending id. Rows are dealt out by ranges of ids
and sorted there; the first row of each range is also sent to the range before. NULL ids come last.
Equal ids follow the hash of their texts; if the first row of a range shares its id with others, the
one that comes first is taken. A single row is its own successor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import constant_table

K = 32
S = 8

_LOWEST_ID = -(1 << 63)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Anchors(NamedTuple):
    """Places (in code points) and hashes of a text's anchors, in order."""

    places: np.ndarray
    values: np.ndarray

    def text(self) -> str:
        return self.values.astype(">u4").tobytes().hex()


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes evenly."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _runs(codes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of ``n`` codes, by doubling; ``n`` is a power of two."""
    h, size = codes + np.uint64(1), 1
    while size < n:
        h = h[:-size] * _power(size) + h[size:]
        size *= 2
    return h


def _window_min(h: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every ``n`` neighbours, by doubling."""
    low, size = h, 1
    while 2 * size <= n:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(low) - (n - size)], low[n - size :]) if n > size else low


def anchors(text: str, k: int = K, s: int = S) -> Anchors:
    """Closed syncmers of a text; ``k`` and ``s`` are powers of two."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(codes):
        return Anchors(np.empty(0, np.int64), np.empty(0, np.uint32))
    if len(codes) >= k:
        inner = _mixed(_runs(codes, s))
        low = _window_min(inner, k - s + 1)
        n = len(low)
        places = np.flatnonzero((inner[:n] == low) | (inner[k - s : k - s + n] == low))
        if len(places):
            return Anchors(places, (_mixed(_runs(codes, k)[places]) >> np.uint64(32)).astype(np.uint32))
    whole = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:4]
    return Anchors(np.zeros(1, np.int64), np.frombuffer(whole, dtype=">u4").astype(np.uint32))


def likeness(a: Anchors, b: Anchors) -> float:
    """Shared anchors over all anchors, with repeats."""
    if not len(a.values) or not len(b.values):
        return float(len(a.values) == len(b.values))
    values, at = np.unique(np.concatenate([a.values, b.values]), return_inverse=True)
    x = np.bincount(at[: len(a.values)], minlength=len(values))
    y = np.bincount(at[len(a.values) :], minlength=len(values))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def matches(a: Anchors, b: Anchors) -> list[tuple[int, int, int]]:
    """Passages that two texts share, as (place in a, place in b, anchors in a row).

    Anchors that occur once in each text are matched; neighbours that keep their distance are joined.
    """
    found: list[list[int]] = []
    once = [dict(zip(v.tolist(), p.tolist(), strict=True)) for p, v in (_single(a), _single(b))]
    last = 0
    for value, at in once[0].items():
        other = once[1].get(value)
        if other is None:
            continue
        if found and other - at == found[-1][1] - found[-1][0] and at - last <= K:
            found[-1][2] += 1
        else:
            found.append([at, other, 1])
        last = at
    return [tuple(x) for x in found]


def _single(a: Anchors) -> Anchors:
    _, at, counts = np.unique(a.values, return_inverse=True, return_counts=True)
    keep = counts[at] == 1
    return Anchors(a.places[keep], a.values[keep])


# ---- successors ----------------------------------------------------------------------------------


def _range_of(cuts: list[int]):
    """Number of a row's range; ranges and the rows in them go from large ids to small."""
    bounds = np.array(cuts, dtype=np.int64)

    def number(ids: pd.Series) -> pd.Series:
        known = ids.fillna(_LOWEST_ID).astype("int64").to_numpy()
        return pd.Series(len(bounds) - np.searchsorted(bounds, known, side="left"))

    number.__annotations__ = {"ids": pd.Series, "return": pd.Series}
    return F.pandas_udf(number, "int")


def successors(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows (doc_id, text, _range, _extra), dealt out and sorted so that within a ``_range`` each row's
    next row holds its successor; the last row of a range (``_extra``) is only a successor."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * partitions
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] or [] if shares else []
    number = _range_of(sorted(set(cuts)))
    order = F.coalesce("doc_id", F.lit(_LOWEST_ID))
    # One row per range.
    heads = ids.groupBy(number("doc_id").alias("r")).agg(F.max(order).alias("head")).orderBy("r").collect()
    before = [{"head": str(h["head"]), "to": heads[i - 1]["r"]} for i, h in enumerate(heads)]
    sent = constant_table(spark, before, "head:string,to:int").select(F.col("head").cast("long").alias("_head"), "to")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("_own", number("doc_id")).join(F.broadcast(sent), order == F.col("_head"), "left")
    targets = F.array(F.struct(F.col("_own").alias("_range"), F.lit(False).alias("_extra")), F.struct(F.col("to").alias("_range"), F.lit(True).alias("_extra")))
    rows = rows.select("doc_id", "text", F.inline(F.filter(targets, lambda t: t["_range"].isNotNull())))
    by = ["_range", "_extra", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    return rows.repartition(partitions, "_range").sortWithinPartitions(*by)


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the following text's beginning."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses. A partition is
    streamed; two texts are held at a time beside the batch."""

    def row(doc_id: int | None, text: str, own: Anchors, following: str, others: Anchors) -> tuple:
        changed = edited(text, following)
        marks = anchors(changed)
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(text), digest, own.text(), marks.text(), likeness(own, marks), likeness(own, others)

    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            out = []
            for doc_id, text, number, extra in zip(*(batch[c] for c in ("doc_id", "text", "_range", "_extra")), strict=True):
                text = text if isinstance(text, str) else ""
                marks = anchors(text)
                if held and held[0] == number:
                    out.append(row(*held[1:], text, marks))
                # Of several first rows with one id, the first to come is the successor.
                held = None if extra else (number, None if pd.isna(doc_id) else int(doc_id), text, marks)
            result = pd.DataFrame(out, columns=columns)
            result["doc_id"] = result["doc_id"].astype("Int64")
            yield result

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return successors(docs).mapInPandas(work, schema)
