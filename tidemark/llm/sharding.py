"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2^16 places. Every shard owns as many points on it as asked for; a row's key hashes to a
place, and the next point clockwise owns the row. A shard takes at most its bound: the rows of its
points beyond that, last points and last ranks first, go on clockwise to the next shard that still has
room. Loads are row counts, and the bounds differ by one row at most and add up to all rows, so the
counts are balanced exactly while only the surplus leaves its owner.

Only DataFrame functions touch rows. What reaches the driver is one count per point of the ring, which
does not grow with the data; what comes back is ranges of ranks per point.

Defined results: a NULL text has size 1, a NULL id hashes like any other value. Equal ids are placed by
size and checksum of their texts; repeated rows are interchangeable and each has a slot of its own. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import constant_table, settle

SHARDS = 16
POINTS = 256
LANES = 16
PLACE_BITS = 16


def _place(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - PLACE_BITS).cast("int")


def ring(spark: SparkSession, shards: int = SHARDS, points: int = POINTS) -> list[tuple[int, int]]:
    """(place, shard) of every point, clockwise. A place that several points want is the lowest shard's.

    A further shard only adds its own points: it takes places from others and moves nothing between
    them.
    """
    n = F.col("id")
    shard, replica = F.floor(n / points).cast("int"), (n % points).cast("int")
    at = spark.range(shards * points).select(_place(F.xxhash64(shard, replica)).alias("place"), shard.alias("shard"))
    return sorted((r["place"], r["shard"]) for r in at.groupBy("place").agg(F.min("shard").alias("shard")).collect())


def _owners(spark: SparkSession, points: list[tuple[int, int]]) -> DataFrame:
    """(place, point) of all 2^16 places: the number of the next point clockwise."""
    rows = [{"low": a[0] + 1, "high": b[0], "point": i + 1} for i, (a, b) in enumerate(zip(points, points[1:], strict=False))]
    rows += [{"low": 0, "high": points[0][0], "point": 0}, {"low": points[-1][0] + 1, "high": (1 << PLACE_BITS) - 1, "point": 0}]
    table = constant_table(spark, [r for r in rows if r["low"] <= r["high"]], "low:int,high:int,point:int")
    return table.select(F.explode(F.sequence("low", "high")).alias("place"), "point")


def bounds(rows: int, shards: int) -> list[int]:
    """The most rows each shard takes: at most one apart, and all rows together."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def balance(counts: list[int], shard_of: list[int], room: list[int]) -> Iterator[dict]:
    """Ranges of ranks per point and the shard and first slot they go to.

    Owners come first, in ring order; then the surplus goes round the ring, oldest first.
    """
    room, slot = list(room), [0] * len(room)
    surplus: list[deque] = [deque() for _ in counts]

    def take(point: int, low: int, n: int, shard: int) -> dict:
        slot[shard] += n
        room[shard] -= n
        return {"point": point, "low": low, "high": low + n, "shard": shard, "slot": slot[shard] - n}

    for point, (n, shard) in enumerate(zip(counts, shard_of, strict=True)):
        own = min(n, room[shard])
        if own:
            yield take(point, 0, own, shard)
        if own < n:
            surplus[point].append((point, own, n))
    carried: deque = deque()
    for turn in range(2):
        for point, shard in enumerate(shard_of):
            if not turn:
                carried.extend(surplus[point])
            while carried and room[shard]:
                origin, low, high = carried.popleft()
                n = min(high - low, room[shard])
                yield take(origin, low, n, shard)
                if low + n < high:
                    carried.appendleft((origin, low + n, high))


def shard_rows(rows: DataFrame, key: str, order: list[str], shards: int = SHARDS, points: int = POINTS) -> DataFrame:
    """Add ``shard`` and ``slot`` to ``rows``. ``order`` ranks rows within a lane of a point; rows of a
    hot key are spread over ``LANES`` lanes by these columns. ``rows`` are read twice."""
    spark = rows.sparkSession
    on_ring = ring(spark, shards, points)
    lane = F.pmod(F.xxhash64(F.col(key), *order), F.lit(LANES))
    placed = rows.withColumns({"_place": _place(F.xxhash64(key)), "_lane": lane})
    # 2^16 rows of two integers, whatever the data.
    placed = placed.join(F.broadcast(_owners(spark, on_ring).toDF("_place", "_point")), "_place").drop("_place")
    sizes = placed.groupBy("_point", "_lane").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_point").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_point", "_lane", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))

    found = {r["_point"]: r["n"] for r in sizes.groupBy("_point").agg(F.sum("_n").alias("n")).collect()}
    counts = [found.get(i, 0) for i in range(len(on_ring))]
    ranges = list(balance(counts, [s for _, s in on_ring], bounds(sum(counts), shards)))
    moves = constant_table(spark, ranges, "point:int,low:long,high:long,shard:int,slot:long")

    within = F.row_number().over(Window.partitionBy("_point", "_lane").orderBy(key, *order))
    ranked = placed.withColumn("_within", within).join(starts, ["_point", "_lane"])
    ranked = ranked.withColumn("_rank", F.col("_start") + F.col("_within") - 1).alias("p")
    here = (F.col("_point") == F.col("m.point")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    # Ranges are as many as points and shards allow.
    return ranked.join(F.broadcast(moves.alias("m")), here).select(
        *[F.col(f"p.{c}") for c in rows.columns],
        F.col("m.shard").alias("shard"),
        (F.col("m.slot") + F.col("_rank") - F.col("low")).alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, points: int = POINTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    rows = settle(
        docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")), "sizes"
    )
    placed = shard_rows(rows, "doc_id", ["size", "text_crc32"], shards, points)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
