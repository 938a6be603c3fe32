"""Ranked lexical search: which documents fit each item of a query set best.

A document's words that some item asks for are counted once and written as numbers. A task then takes its
documents block by block. Every term has a bitmap over the block; an item's bitmaps, turned, give each
document the mask of the item's terms that it holds. Documents with one mask form a group, whose score can
not exceed the sum of its terms' best possible parts in the block. Groups are evaluated from the highest
such sum down, until the next one is below the item's ``k``-th score so far, which the task carries from
block to block. What a task finds, ``k`` rows per item at most, is merged in two steps.

The score follows whole numbers: ``w = floor(1000 ln((2N+2) / (2df+1)))`` for a term, a document's length
``m = 10 + (90 n N) div L``, and the sum of ``w * ((10^9 tf) div (1000 tf + 8 m))`` over the item's terms.

Items are taken in blocks of bounded size, one after the other, so that the vocabulary of a block can be
sent to every task; each block reads all documents.

Defined results: a NULL or termless text is no document for ``N`` and ``L``, and a NULL or termless item has
no results. Rows of items with one id (or NULL) are one item, each of its terms counted once. Every
document row counts for itself, also repeated ones; equal scores go by ascending doc_id, NULL last. Fewer
documents with a score above 0 than ``k`` give fewer rows, and an empty table on either side gives none.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settle, slices

TOP = 10
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_BYTES = 8_000_000  # of an item block's terms, and with them of what is sent to a task
LANES = 64
_CHUNK = 128  # documents whose scores are computed in one go, at least

_LAST = np.int64((1 << 63) - 1)
# Of the bytes below 128 digits and letters remain, letters as small ones.
_PLAIN = bytes(ord(chr(i).lower()) if i > 127 or chr(i).isalnum() else 32 for i in range(128)) + bytes(range(128, 256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_PLAIN).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the terms of each item, once each."""
    lower = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    found = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
    return found.distinct()


# ---- words of documents --------------------------------------------------------------------------


def counted(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), and for the terms in ``numbers`` their numbers, ascending, and frequencies."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = len(numbers)
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in slices(texts):
                words = [terms_of(t) if isinstance(t, str) else [] for t in texts[a:b]]
                sizes = np.array([len(w) for w in words], dtype=np.int64)
                flat = np.concatenate([np.fromiter(map(numbers.get, w, repeat(-1)), dtype=np.int64, count=len(w)) for w in words])
                row = np.repeat(np.arange(len(words)), sizes)[flat >= 0]
                key, tf = np.unique(row * width + flat[flat >= 0], return_counts=True)
                cuts = np.searchsorted(key, np.arange(1, len(words)) * width)
                out = pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].astype("Int64").to_numpy(), "n": sizes})
                out["terms"], out["tfs"] = np.split((key % width).astype(np.int32), cuts), np.split(tf.astype(np.int64), cuts)
                yield out[out["n"] > 0]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(work, "doc_id long, n long, terms array<int>, tfs array<long>")


# ---- a block of documents ------------------------------------------------------------------------


class Block:
    """Counted documents with the bitmaps of their terms."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, width: int):
        self.ids, self.m, self.width = ids, m, width
        row = np.repeat(np.arange(len(ids)), sizes)
        self.key, self.tf = row * width + terms, tfs  # ascending
        self.used, at = np.unique(terms, return_inverse=True)
        present = np.zeros((len(self.used), -(-len(ids) // 8)), dtype=np.uint8)
        np.bitwise_or.at(present, (at, row >> 3), np.uint8(128) >> (row & 7).astype(np.uint8))
        self.bitmaps = present
        self.most = np.zeros(len(self.used), dtype=np.int64)
        np.maximum.at(self.most, at, tfs)

    def groups(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of an item's terms (ascending): those present, the masks that occur as rows of bits, and the
        documents by mask with the first of each group."""
        at = np.searchsorted(self.used, wanted)
        here = at[at < len(self.used)]
        here = here[self.used[here] == wanted[at < len(self.used)]]
        if not len(here):
            return here, np.empty((0, 0), dtype=bool), here, here
        bits = np.unpackbits(self.bitmaps[here], axis=1, count=len(self.ids))
        packed = np.packbits(bits, axis=0)
        packed = np.pad(packed, ((0, -len(packed) % 8), (0, 0)))
        masks = np.ascontiguousarray(packed.T).view(np.uint64)
        docs = np.flatnonzero(masks.any(axis=1))
        masks = masks[docs]
        order = np.lexsort(masks.T) if masks.shape[1] > 1 else np.argsort(masks[:, 0], kind="stable")
        docs, masks = docs[order], masks[order]
        first = np.flatnonzero(np.append(True, (masks[1:] != masks[:-1]).any(axis=1))) if len(docs) else docs
        return here, bits[:, docs[first]].T.astype(bool), docs, first

    def scores(self, docs: np.ndarray, bits: np.ndarray, here: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores; ``bits`` has the terms that each document holds, one at least."""
        i, j = np.nonzero(bits)
        tf = self.tf[np.searchsorted(self.key, docs[i] * self.width + self.used[here[j]])]
        parts = weights[j] * (1_000_000_000 * tf // (1000 * tf + 8 * self.m[docs[i]]))
        return np.add.reduceat(parts, np.searchsorted(i, np.arange(len(docs))))

    def best(self, wanted: np.ndarray, weights: np.ndarray, held: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """``held`` (scores, ids of the best so far) with this block's documents, ``k`` at most."""
        here, bits, docs, first = self.groups(wanted)
        if not len(docs):
            return held
        weights = weights[np.searchsorted(wanted, self.used[here])]
        most = self.most[here]
        highest = weights * (1_000_000_000 * most // (1000 * most + 8 * self.m.min()))
        bound = bits.astype(np.int64) @ highest
        order = np.argsort(-bound, kind="stable")
        size = np.diff(np.append(first, len(docs)))
        reach = np.cumsum(size[order])
        done = 0
        scores, ids = held
        while done < len(order):
            if len(scores) == k and bound[order[done]] < scores[-1] or bound[order[done]] <= 0:
                break
            upto = int(np.searchsorted(reach, (reach[done - 1] if done else 0) + max(_CHUNK, 2 * k))) + 1
            chosen = order[done:upto]
            members = np.concatenate([docs[first[g] : first[g] + size[g]] for g in chosen])
            got = self.scores(members, np.repeat(bits[chosen], size[chosen], axis=0), here, weights)
            some = got > 0
            scores, ids = np.append(scores, got[some]), np.append(ids, self.ids[members[some]])
            top = np.lexsort((ids, -scores))[:k]
            scores, ids, done = scores[top], ids[top], upto
        return scores, ids


def _flat(lists: pd.Series) -> np.ndarray:
    return np.concatenate([np.asarray(x, dtype=np.int64) for x in lists]) if len(lists) else np.empty(0, np.int64)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of each item with the highest scores above 0."""
    pairs = settle(item_terms(items), "item-terms")
    total = pairs.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    parts = []
    for b in range(blocks):
        block = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        # BLOCK_BYTES and one item's terms at most.
        parts.append(_search_block(docs, [(r["item_id"], r["term"]) for r in block.collect()], k))
    return reduce(DataFrame.unionByName, parts)


def _search_block(docs: DataFrame, pairs: list[tuple[int | None, str]], k: int) -> DataFrame:
    spark = docs.sparkSession
    numbers = {t.encode(): i for i, t in enumerate(sorted({t for _, t in pairs}))}
    rows = settle(counted(docs, numbers), "counted")
    documents, words = rows.agg(F.count("*"), F.sum("n")).first()
    # One row per term of the item block.
    holding = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weight = np.zeros(len(numbers), dtype=np.int64)
    for t, df in holding.items():
        weight[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    asked: dict[int | None, list[int]] = {}
    for item, term in pairs:
        asked.setdefault(item, []).append(numbers[term.encode()])
    wanted = [(item, np.sort(np.array(terms))) for item, terms in asked.items()]
    width = len(numbers)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = (np.empty(0, np.int64), np.empty(0, np.int64))
        held = [none] * len(wanted)
        for batch in batches:
            sizes = batch["terms"].map(len).to_numpy()
            m = 10 + (90 * batch["n"].to_numpy(np.int64) * documents) // words
            ids = batch["doc_id"].astype("Int64").fillna(_LAST).to_numpy(np.int64)
            block = Block(ids, m, sizes, _flat(batch["terms"]), _flat(batch["tfs"]), width)
            held = [block.best(t, weight[t], h, k) for (_, t), h in zip(wanted, held, strict=True)]
        for (item, _), (scores, ids) in zip(wanted, held, strict=True):
            if len(scores):
                known = pd.array(ids, dtype="Int64")
                known[ids == _LAST] = pd.NA
                yield pd.DataFrame({"item_id": pd.array([item] * len(ids), dtype="Int64"), "doc_id": known, "score": scores})

    found = rows.mapInPandas(work, "item_id long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = found.withColumn("_lane", F.pmod(F.spark_partition_id(), F.lit(LANES)))
    for by in (["item_id", "_lane"], ["item_id"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")
