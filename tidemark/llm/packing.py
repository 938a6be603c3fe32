"""Packing documents into sequences of a fixed number of tokens.

Large items (above a third of the capacity) fit at most twice into a sequence: greedy matching gives
the largest one the largest other that still fits beside it. Smaller items then go, longest first,
into the sequence with the tightest gap that takes them, and open a new one if none does.

A plan depends only on how many pieces there are of each length, which are ``capacity`` numbers at
most: these reach the driver, and the plan comes back as ranges of ranks per length. Pieces are ranked
per length in lanes, so that a length that a third of all documents have is ranked by many tasks.

Defined results: NULL and empty texts are the end token alone. Ranks among equal lengths follow lane
and id; repeated rows are pieces of their own. An empty table gives no sequences.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import byte_alphabet
from tidemark.llm.common import constant_table, settle, text_udf, vocabulary

CAPACITY = 2048
END_ID = 0
LANES = 256

# Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_unwieldy = re.compile(r"\s{10000}|\S{20000}").search


class Ids:
    """Token ids of a byte-level vocabulary; the added tokens' strings count as those tokens.

    Two public libraries give the same ids. The one that reads ranks is several times as fast, but
    slow on runs of many thousands of characters without a break, which go to the other.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = {c: b for b, c in byte_alphabet().items()}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.merging = Tokenizer.from_file(path)

    def encode(self, text: str) -> list[int]:
        if _unwieldy(text):
            return self.merging.encode(text, add_special_tokens=False).ids
        return self.ranked.encode(text, allowed_special="all")


@lru_cache(maxsize=2)
def ids_of(path: str) -> Ids:
    return Ids(path)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every document, ids as little-endian 32-bit integers.

    A document longer than ``capacity`` is cut so that only its first piece may be shorter.
    """
    path = path or vocabulary("byte_bpe_50k.json")

    def cut(ids: list[int]) -> Iterator[dict]:
        packed = np.asarray([*ids, END_ID], dtype="<u4")
        short = (len(packed) - 1) % capacity + 1
        bounds = [0, *range(short, len(packed) + 1, capacity)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            yield {"piece": i, "start": a, "length": b - a, "ids": packed[a:b].tobytes()}

    def work(texts: list[str]) -> pd.DataFrame:
        encode = ids_of(path).encode
        return pd.DataFrame({"pieces": [list(cut(encode(t))) for t in texts]})

    run = text_udf(work, "pieces array<struct<piece:int,start:long,length:long,ids:binary>>")
    return docs.select("doc_id", run("text")["pieces"].alias("_p")).select("doc_id", F.inline("_p"))


# ---- the plan ------------------------------------------------------------------------------------


def _match(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Sequences of one or two large items each, as (how many, lengths)."""
    left = {n: c for n, c in counts.items() if c and 3 * n > capacity}
    order, groups = sorted(left), []
    while order:
        a = order[-1]
        left[a] -= 1  # the one that looks for a partner is not its own
        at = bisect_right(order, capacity - a)
        b = next((order[i] for i in range(at - 1, -1, -1) if left[order[i]]), None)
        left[a] += 1
        if b is None:
            n, items = left[a], [a]
        elif b == a:
            n, items = left[a] // 2, [a, a]
        else:
            n, items = min(left[a], left[b]), [a, b]
        groups.append((n, items))
        for item in items:
            left[item] -= n
        order = [x for x in order if left[x]]
    return groups


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """All sequences as (how many, lengths in order)."""
    groups = _match(counts, capacity)
    gaps: dict[int, list[tuple[int, list[int]]]] = {}
    for n, items in groups:
        gaps.setdefault(capacity - sum(items), []).append((n, items))
    order = sorted(gaps)

    def put(gap: int, n: int, items: list[int]) -> None:
        if gap not in gaps:
            gaps[gap] = []
            insort(order, gap)
        gaps[gap].append((n, items))

    for length in sorted((n for n, c in counts.items() if c and 3 * n <= capacity), reverse=True):
        todo = counts[length]
        while todo:
            at = bisect_right(order, length - 1)
            if at == len(order):
                each = capacity // length
                put(capacity, -(-todo // each), [])
                continue
            gap = order[at]
            n, items = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            each = min(gap // length, todo)
            used = min(n, todo // each)
            if n > used:
                put(gap, n - used, items)
            put(gap - each * length, used, items + [length] * each)
            todo -= used * each
    return [group for gap in order for group in gaps[gap]]


def _ranges(groups: list[tuple[int, list[int]]]) -> list[dict]:
    """Which ranks of a length go to which sequences, at which offset."""
    next_rank: dict[int, int] = {}
    rows, sequence = [], 0
    for n, items in groups:
        offset = 0
        for length in items:
            rank = next_rank.get(length, 0)
            rows.append({"length": length, "low": rank, "high": rank + n, "first": sequence, "offset": offset})
            next_rank[length] = rank + n
            offset += length
        sequence += n
    return rows


def _ranked(table: DataFrame, ties: list[Column]) -> DataFrame:
    """Rank from 0 among the pieces of a length, by lane and then by ``ties``."""
    lane = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(LANES))
    table = table.withColumn("_lane", lane)
    before = Window.partitionBy("length").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = table.groupBy("length", "_lane").agg(F.count("*").alias("_n"))
    starts = starts.select("length", "_lane", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("length", "_lane").orderBy(*ties))
    ranked = table.withColumn("_within", within).join(starts, ["length", "_lane"])
    return ranked.withColumn("_rank", F.col("_start") + F.col("_within") - 1).drop("_start", "_within", "_lane")


def pack(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``doc_id``, ``piece`` and a ``length`` from 1 to
    ``capacity``. The table is read twice, so it should be one that is not computed anew."""
    spark = table.sparkSession
    counts = {r["length"]: r["count"] for r in table.groupBy("length").count().collect()}  # `capacity` rows at most
    rows = _ranges(plan(counts, capacity))
    ranges = constant_table(spark, rows, "length:long,low:long,high:long,first:long,offset:long")
    ranked = _ranked(table, [F.col("doc_id"), F.col("piece")]).alias("p")
    # A plan has a few rows per length; its size depends on the capacity, not on the corpus.
    here = (F.col("p.length") == F.col("r.length")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    joined = ranked.join(F.broadcast(ranges.alias("r")), here)
    return joined.select(
        *[F.col(f"p.{c}") for c in table.columns],
        (F.col("first") + F.col("_rank") - F.col("low")).alias("sequence_id"),
        F.col("r.offset").alias("offset"),
    )


def packed_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pieces with a digest in place of their ids, packed."""
    cut = pieces(docs, capacity, path)
    digest = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(settle(digest, "pieces"), capacity)
