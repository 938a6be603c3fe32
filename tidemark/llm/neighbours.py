"""Nearest neighbours by cross-polytope hashing.

A hash function turns a unit vector by three rounds of random signs and a fast Hadamard transform and
takes the nearest signed axis. A table combines functions, and what they say together is a bucket. The
functions grow with the logarithm of the rows: two at least, and about as many buckets as rows; the last
function looks at as many axes as this takes. A query probes the buckets that fit it best in every
table, and whatever lies there is compared exactly, in double precision on the original vectors.

Neighbours that stay far apart however many rows there are need larger buckets. So the index is fitted:
the nearest of ``SAMPLE`` query vectors are found by brute force over all rows, and the buckets are
halved in number, down to two functions, and then probes doubled, until ``RECALL`` of these are met.

Copies of a vector are indexed as far as they can be among the results: the ``k + 1`` smallest ids. The
buckets of a table are dealt to shelves in their order, as many as the number of rows asks for; a
shelf's rows are split by a hash of the id into groups of bounded size, however unevenly they lie, and
queries into blocks; a group and a block meet in one task, where a bucket's rows are looked up.

Defined results: vectors that are NULL, zero, of another length than most, or hold NULL or non-finite
components take no part. Ties go to the smaller id; repeated ids count once. Fewer candidates than
``k`` give fewer rows, an empty table none. Recall depends on ``TABLES`` and ``PROBES``; the tests
measure it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settle

TABLES = 16
PROBES = 384  # buckets per table, at least
SAMPLE = 64  # queries that the index is fitted on
RECALL = 0.95  # of their neighbours are met
NEIGHBOURS = 10
SEED = 20_240
GROUP_ROWS = 8_192
GROUP_QUERIES = 4_096


def _transform(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row; the length is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        x = np.stack([a + b, a - b], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def axis_bits(width: int) -> int:
    """Bits of a signed axis of vectors of so many components, padded to a power of two."""
    return 1 + max(1, (width - 1).bit_length())


def bucket_bits(rows: int, width: int) -> int:
    """Bits of a bucket: about one bucket for each row, two functions at least."""
    return max(2 * axis_bits(width), math.ceil(math.log2(max(1, rows))))


def _fits(vectors: np.ndarray, bits: int, tables: int, seed: int) -> Iterator[list[np.ndarray]]:
    """For each table and function: each vector's fit with axis 0 positive, axis 0 negative, axis 1 positive ..."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    each = axis_bits(vectors.shape[1])
    padded = np.zeros((len(unit), 1 << each - 1))
    padded[:, : unit.shape[1]] = unit
    full, rest = divmod(bits, each)
    axes = [1 << each] * full + [1 << rest] * (rest > 0)
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, len(axes), 3, padded.shape[1]))
    for of_table in signs:
        out = []
        for of_function, kept in zip(of_table, axes, strict=True):
            y = padded
            for s in of_function:
                y = _transform(y * s)
            out.append(np.stack([y, -y], axis=2).reshape(len(y), -1)[:, :kept])
        yield out


def buckets(vectors: np.ndarray, bits: int, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """[vector, table]: the nearest signed axes of all functions as one number."""
    out = np.zeros((len(vectors), tables), dtype=np.int64)
    for t, fits in enumerate(_fits(vectors, bits, tables, seed)):
        for fit in fits:
            out[:, t] = out[:, t] * fit.shape[1] + fit.argmax(axis=1)
    return out


def _best(fits: list[np.ndarray], count: int) -> np.ndarray:
    """The ``count`` buckets of the highest summed fits. A bucket can only be among them if its functions but the last are."""
    total, found = np.zeros(1), np.zeros(1, dtype=np.int64)
    for fit in fits:
        total = (total[:, None] + fit[None, :]).ravel()
        found = (found[:, None] * len(fit) + np.arange(len(fit))).ravel()
        if len(total) > count:
            kept = np.argpartition(-total, count - 1)[:count]
            total, found = total[kept], found[kept]
    return np.sort(found)


def probes(vectors: np.ndarray, bits: int, tables: int = TABLES, count: int = PROBES, seed: int = SEED) -> Iterator[list[np.ndarray]]:
    """Per table: each vector's buckets worth probing, in order."""
    for fits in _fits(vectors, bits, tables, seed):
        yield [_best([f[i] for f in fits], count) for i in range(len(vectors))]


def met(asked: np.ndarray, near: np.ndarray, owner: np.ndarray, bits: int, tables: int, count: int) -> float:
    """The share of ``near`` that lie where their ``owner`` among ``asked`` probes."""
    at, found = buckets(near, bits, tables), np.zeros(len(near), dtype=bool)
    for t, of_table in enumerate(probes(asked, bits, tables, count)):
        found |= np.array([x in of_table[o] for x, o in zip(at[:, t], owner, strict=True)])
    return float(found.mean())


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id IS NOT NULL")
    finite = rows.where(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    common = finite.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return finite.where(F.size(v) == (common["n"] if common else 0))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(float)


def _batchwise(work, schema: str):
    work.__annotations__ = {"v": pd.Series, "return": pd.Series}
    return F.pandas_udf(work, schema)


def _nearest_of_sample(index: DataFrame, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest other vectors of each of ``asked``, by brute force, and whose they are."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({"owner": [], "d": [], "v": []})
        for batch in batches:
            x = _matrix(batch["v"]) if len(batch) else np.empty((0, asked.shape[1]))
            parts = [best]
            for i, q in enumerate(asked):
                d = ((x - q) ** 2).sum(axis=1)
                at = np.flatnonzero(d > 0)
                at = at[np.argsort(d[at])[:k]]
                parts.append(pd.DataFrame({"owner": i, "d": d[at], "v": list(x[at])}))
            best = pd.concat([p for p in parts if len(p)] or parts[:1]).sort_values("d").groupby("owner").head(k)
        yield best

    found = index.select("v").distinct().mapInPandas(work, "owner int, d double, v array<double>")
    place = F.row_number().over(Window.partitionBy("owner").orderBy("d"))
    rows = found.withColumn("place", place).where(F.col("place") <= k).toPandas()
    return (_matrix(rows["v"]) if len(rows) else np.empty((0, asked.shape[1]))), rows["owner"].to_numpy(dtype=int)


def fitted(index: DataFrame, asked: DataFrame, rows: int, k: int, tables: int, count: int) -> tuple[int, int]:
    """Bits of a bucket and probes per table by which ``RECALL`` of a sample's neighbours are met."""
    sample = asked.orderBy(F.xxhash64("query"), "query").limit(SAMPLE).toPandas()
    if not len(sample):
        return 2, count
    vectors = _matrix(sample["v"])
    bits, least = bucket_bits(rows, vectors.shape[1]), 2 * axis_bits(vectors.shape[1])
    near, owner = _nearest_of_sample(index, vectors, k)
    while len(near) and count < 1 << bits and met(vectors, near, owner, bits, tables, count) < RECALL:
        if bits > least:
            bits -= 1
        else:
            count *= 2
    return bits, count


def nearest(rows: DataFrame, is_query: Column, k: int = NEIGHBOURS, tables: int = TABLES, count: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query row, itself left out.

    ``rows`` are as ``usable`` gives them.
    """
    rows = settle(rows, "vectors")
    copies = Window.partitionBy("v").orderBy("vec_id")
    index = rows.distinct().withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1)
    queries = rows.where(is_query).distinct()
    asked = settle(queries.groupBy("v").agg(F.min("vec_id").alias("query")), "asked")

    index = settle(index.drop("_copy"), "distinct")
    n = index.count()
    bits, count = fitted(index, asked, n, k, tables, count)
    # In their order, so that a query's probes are on few shelves; as many shelves as two functions have buckets, at most.
    of_shelf = max(0, bits - max(0, min(18, math.ceil(math.log2(max(1, n / GROUP_ROWS))))))
    placed = _batchwise(lambda v: pd.Series(list(buckets(_matrix(v), bits, tables).tolist())), "array<long>")
    kept = index.select("vec_id", "v", F.posexplode(placed("v")).alias("t", "bucket"))
    kept = settle(kept.withColumn("shelf", F.shiftright("bucket", of_shelf).cast("int")), "index")

    def on_shelves(v: pd.Series) -> pd.Series:
        out: list[list[dict]] = [[] for _ in v]
        for t, of_table in enumerate(probes(_matrix(v), bits, tables, count)):
            for wanted, found in zip(out, of_table, strict=True):
                shelves, first = np.unique(found >> of_shelf, return_index=True)
                wanted += [{"t": t, "shelf": int(x), "probed": p.tolist()} for x, p in zip(shelves, np.split(found, first[1:]), strict=True)]
        return pd.Series(out)

    probed = _batchwise(on_shelves, "array<struct<t:int,shelf:int,probed:array<long>>>")
    wanted = settle(asked.select("query", "v", F.inline(probed("v"))), "probes")

    # Groups and blocks per table and shelf: tables x 2^18 rows at most, whatever the data.
    rows_at = kept.groupBy("t", "shelf").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("groups"))
    queries_at = wanted.groupBy("t", "shelf").agg(F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("blocks"))
    split = settle(rows_at.join(queries_at, ["t", "shelf"]), "split")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = wanted.join(split, ["t", "shelf"]).select(
        "t", "shelf", F.pmod(F.xxhash64("query"), "blocks").cast("int").alias("block"), every("groups").alias("group"), "query", "v", "probed"
    )
    right = kept.join(split, ["t", "shelf"]).select(
        "t", "shelf", F.pmod(F.xxhash64("vec_id"), "groups").cast("int").alias("group"), every("blocks").alias("block"), "vec_id", "v", "bucket"
    )

    def compare(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(asked) and len(there):
            there = there.sort_values("bucket")
            ids, vectors, bucket = there["vec_id"].to_numpy(), _matrix(there["v"]), there["bucket"].to_numpy()
            for query, v, probed in zip(asked["query"], asked["v"], asked["probed"], strict=True):
                first, end = np.searchsorted(bucket, probed), np.searchsorted(bucket, probed, side="right")
                sizes = end - first
                at = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
                d = np.sqrt(((vectors[at] - np.asarray(v, dtype=float)) ** 2).sum(axis=1))
                best = np.lexsort((ids[at], d))[: k + 1]
                found.append((np.full(len(best), query), ids[at[best]], d[best]))
        if not found:
            return pd.DataFrame({"query": [], "vec_id": [], "score": []})
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(("query", "vec_id", "score"), zip(*found, strict=True), strict=True)})

    keys = ["t", "shelf", "group", "block"]
    compared = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "query long, vec_id long, score double")
    by_score = Window.partitionBy("query").orderBy("score", "vec_id")
    best = compared.groupBy("query", "vec_id").agg(F.min("score").alias("score"))
    best = best.withColumn("_place", F.row_number().over(by_score)).where(F.col("_place") <= k + 1).drop("_place")
    named = queries.withColumnRenamed("vec_id", "query_id").join(asked, "v").select("query_id", "query")
    mine = named.join(settle(best, "best"), "query").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return mine.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
