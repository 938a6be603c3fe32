"""SimHash fingerprints of word shingles, linked by covering locality-sensitive hashing.

Every bit position gets a non-zero vector of ``radius + 1`` bits, and every non-zero vector of that
length is a table, whose mask keeps the positions that have an odd product with it. Two fingerprints
that differ in at most ``radius`` positions agree on some mask: fewer vectors than dimensions leave a
direction that is orthogonal to all of them. So no pair within the radius is missed.

Equal fingerprints are one node. Nodes that share a bucket with another are candidates. They are
compared without forming pairs: two fingerprints differ in at most two bits exactly if some value is
within one bit of both, so each candidate names itself and its one-bit neighbours (in the bits that
its shared buckets leave open), and whoever names the same value is linked. A value has 65 names at
most, however large a bucket is.

Defined results: NULL and wordless texts have fingerprint 0. Rows without an id get a fingerprint and
the component of their fingerprint, which is NULL if no row of it has an id. Repeated rows are one
document. Equal ids with different texts are members of both texts' components.
"""

from __future__ import annotations

from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle, text_udf
from tidemark.llm.components import components

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42


def _fingerprint(text: str, shingle: int) -> int:
    words = text.encode().lower().split()  # of bytes: A-Z only, and only ASCII white space
    if not words:
        return 0
    grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)) if len(words) >= shingle else [b" ".join(words)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype=">u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(">i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The 64 bits as a signed long. A bit is 1 if more than half of the shingles' hashes have it."""
    run = text_udf(
        lambda texts: pd.DataFrame({"bits": np.array([_fingerprint(t, shingle) for t in texts], dtype=np.int64)}),
        "bits long",
    )
    return run(text)["bits"]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask per table, as signed longs."""
    vectors = (1 << (radius + 1)) - 1
    of_bit = [1 + i % vectors for i in range(bits)]
    return [
        _signed(sum(1 << i for i, m in enumerate(of_bit) if (m & v).bit_count() % 2))
        for v in range(1, vectors + 1)
    ]


def _candidates(nodes: DataFrame, masks: list[int]) -> DataFrame:
    """Nodes that share a bucket, with the bits that those buckets leave open."""
    table = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("mask")) for i, m in enumerate(masks)]))
    placed = nodes.select("node", "bits", table.alias("_t")).select(
        "node", "bits", F.col("_t.t").alias("t"), F.col("_t.mask").alias("mask"), F.col("bits").bitwiseAND(F.col("_t.mask")).alias("bucket")
    )
    shared = placed.groupBy("t", "bucket").agg(F.count("*").alias("n")).where("n > 1").select("t", "bucket")
    # Written first, so that the join shuffles both sides and a full bucket can be split.
    members = placed.join(settle(shared, "shared"), ["t", "bucket"])
    return members.groupBy("node", "bits").agg(F.bit_or(F.bitwise_not("mask")).alias("open"))


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that connect exactly the nodes within ``radius`` (0 or 2) bits of each other.

    ``nodes`` has distinct ``bits``, each with its ``node``. Not every such pair becomes an edge of its
    own, but each is connected through nodes that name the same value.
    """
    if radius not in (0, 2):
        raise ValueError("links are formed for 0 or 2 differing bits")
    if radius == 0:
        return nodes.select(F.col("node").alias("u"), F.col("node").alias("v"))
    one_off = [F.when(F.col("open").bitwiseAND(F.lit(_signed(1 << i))) != 0, F.col("bits").bitwiseXOR(F.lit(_signed(1 << i)))) for i in range(BITS)]
    named = _candidates(nodes, covering_masks(radius)).select(
        "node", F.explode(F.array_compact(F.array(F.col("bits"), *one_off))).alias("value")
    )
    met = named.groupBy("value").agg(F.collect_list("node").alias("who")).where(F.size("who") > 1)
    return met.select(F.explode("who").alias("u"), F.array_min("who").alias("v")).where("u != v").distinct()


class Groups(NamedTuple):
    """``prints`` (doc_id, bits) of every row, ``nodes`` (bits, node: its smallest id) and ``found``
    (node, component) of the nodes that are not the smallest of their component."""

    prints: DataFrame
    nodes: DataFrame
    found: DataFrame


def _grouped(docs: DataFrame, shingle: int, radius: int) -> Groups:
    prints = settle(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("bits")), "prints")
    nodes = settle(
        prints.groupBy("bits").agg(F.min("doc_id").alias("node")).where(F.col("node").isNotNull()), "nodes"
    )
    return Groups(prints, nodes, components(links(nodes, radius)))


def near_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, bits, component_id) of every row."""
    prints, nodes, found = _grouped(docs, shingle, radius)
    of_bits = nodes.join(found, "node", "left").select("bits", F.coalesce("component", "node").alias("component_id"))
    return prints.join(of_bits, "bits", "left").select("doc_id", "bits", "component_id")


def hex_bits(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group, with its columns as they are: the one with the smallest id, of several
    texts under that id the one with the smallest fingerprint, of repeated rows any.

    Rows without an id go if a row with an id has their fingerprint; otherwise one of each fingerprint
    stays.
    """
    prints, nodes, found = _grouped(docs, shingle, radius)
    chosen = nodes.join(found, "node", "left_anti").groupBy("node").agg(F.min("bits").alias("bits"))
    seen = settle(prints.groupBy("bits", "doc_id").agg(F.count("*").alias("n")), "seen")
    with_id = seen.where("doc_id IS NOT NULL").join(chosen.withColumnRenamed("node", "doc_id"), ["bits", "doc_id"], "left_anti")
    without = seen.where("doc_id IS NULL").join(nodes, "bits", "left_semi")
    gone = settle(with_id.unionByName(without).select("bits", "doc_id"), "gone")
    repeated = seen.where("n > 1").select("bits", "doc_id").join(gone.toDF(*_KEY), _same(), "left_anti")
    repeated = settle(repeated, "repeated")

    rows = docs.select(F.struct("*").alias("row"), "doc_id", fingerprint(F.col("text"), shingle).alias("bits"))
    single = rows.join(gone.union(repeated).toDF(*_KEY), _same(), "left_anti")
    if repeated.isEmpty():  # as it is where ids are unique; spares a second look at the texts
        return single.select("row.*")
    one = rows.join(repeated.toDF(*_KEY), _same(), "left_semi").dropDuplicates(["bits", "doc_id"])
    return single.unionByName(one).select("row.*")


_KEY = ("its_bits", "its_id")


def _same() -> Column:
    """Fingerprint and id are those of the other side; NULL ids are equal."""
    return (F.col("bits") == F.col("its_bits")) & F.col("doc_id").eqNullSafe(F.col("its_id"))
