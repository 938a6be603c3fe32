"""Bounded batches, pages and row numbers over a whole table, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidemark.session import work_dir

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition here


def with_row_index(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the 0-based position of every row in the global order ``order``.

    A range sort places the rows, ``checkpoint()`` pins the placing, and each partition then
    needs only its own offset. The offsets are one row per partition: that is all that a single
    task sees or that is broadcast.
    """
    work_dir(df.sparkSession)
    placed = df.orderBy(*order).checkpoint()
    mark = F.monotonically_increasing_id()
    placed = placed.select(
        "*",
        F.shiftright(mark, _ROW_BITS).alias("_part"),
        mark.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start")
    )


class By(NamedTuple):
    """A column that rows are ordered by. NULLs come first in ascending and last in descending order."""

    column: str
    descending: bool = False

    @property
    def order(self) -> Column:
        return F.col(self.column).desc() if self.descending else F.col(self.column).asc()


class Place(NamedTuple):
    """Sort columns of a row, and how many rows come before it, and up to it and its equals."""

    at: tuple[Column | None, ...]
    before: int
    upto: int


DEEP = 10_000  # rows that every task may send to one
FEW = 20_000  # rows whose sort columns the driver sorts at the end
SAMPLE = 1_024  # rows from which the cuts of a pass are chosen
MARGIN = 48  # rows of the sample on either side, three deviations of where the rank may be


def _beyond(by: Sequence[By], at: Sequence[Column | None], or_at: bool = False) -> Column:
    """Whether a row comes after ``at`` (or stands there, with ``or_at``)."""
    after, same = F.lit(False), F.lit(True)
    for b, value in zip(by, at, strict=True):
        c = F.col(b.column)
        if value is None:
            later = F.lit(False) if b.descending else c.isNotNull()
            equal = c.isNull()
        else:
            later = (c.isNull() | (c < value)) if b.descending else c.isNotNull() & (c > value)
            equal = c.eqNullSafe(value)
        after, same = after | (same & later), same & equal
    return after | same if or_at else after


def _from(df: DataFrame, by: Sequence[By], at: Sequence[Column | None], or_at: bool) -> DataFrame:
    """Rows after a place. The first column's bound stands alone too, where the scan's statistics see it."""
    first, value = F.col(by[0].column), at[0]
    if value is not None:
        df = df.where(first.isNull() | (first <= value) if by[0].descending else first >= value)
    return df.where(_beyond(by, at, or_at))


def _until(df: DataFrame, by: Sequence[By], at: Sequence[Column | None], or_at: bool) -> DataFrame:
    """Rows before a place."""
    first, value = F.col(by[0].column), at[0]
    if value is not None:
        df = df.where(first >= value if by[0].descending else first.isNull() | (first <= value))
    return df.where(~_beyond(by, at, or_at=not or_at))


def place_of(df: DataFrame, by: Sequence[By], rank: int) -> Place | None:
    """Where the row number ``rank`` (from 0) of ``df`` stands in the order; None if there are fewer.

    Each pass takes a few cuts from a random sample, one where the rank should be and one on either side, and
    counts the rows before and up to each of them, in one aggregate: no row is moved. What lies between the
    two cuts around the rank is looked at next, some ten times less each time, until the rank is at a cut, as it is in a heap of equal rows, or so few
    rows remain (``FEW``) that their sort columns go to the driver.
    """
    kinds = [df.schema[b.column].dataType for b in by]
    # An instant stays a number on its way through the driver.
    shown = [F.unix_micros(b.column) if isinstance(k, TimestampType) else F.col(b.column) for b, k in zip(by, kinds, strict=True)]
    shown = [c.alias(f"_{i}") for i, c in enumerate(shown)]

    def places(rows: list) -> list[tuple[Column | None, ...]]:
        literal = [F.timestamp_micros if isinstance(k, TimestampType) else (lambda c: c) for k in kinds]
        return [tuple(None if v is None else f(F.lit(v)) for f, v in zip(literal, r, strict=True)) for r in rows]

    keys, order = df.select(*[b.column for b in by]), [b.order for b in by]
    size, before = keys.count(), 0
    if rank >= size:
        return None
    while True:
        here = rank - before
        if size <= FEW:
            rows = [tuple(r) for r in keys.orderBy(*order).select(*shown).collect()]
            first = rows.index(rows[here]) if rows[here] == rows[here] else here
            last = first
            while last < len(rows) and rows[last] == rows[first]:
                last += 1
            return Place(places(rows[here : here + 1])[0], before + first, before + max(last, here + 1))
        some = keys.orderBy(F.rand(rank)).limit(SAMPLE).orderBy(*order).select(*shown).collect()
        middle = here * len(some) // size
        chosen = {some[min(max(i, 0), len(some) - 1)]: None for i in (middle - MARGIN, middle, middle + MARGIN)}
        cuts = places(list(chosen))
        counts = [F.count_if(_beyond(by, c, or_at)).alias(f"n{i}{or_at}") for i, c in enumerate(cuts) for or_at in (True, False)]
        counted = list(keys.agg(*counts).first())
        ranked = [(size - a, size - b, c) for a, b, c in zip(counted[::2], counted[1::2], cuts, strict=True)]
        at = next((x for x in ranked if x[0] <= here < x[1]), None)
        if at:
            return Place(at[2], before + at[0], before + at[1])
        low = next((x for x in reversed(ranked) if x[1] <= here), None)
        high = next((x for x in ranked if x[0] > here), None)
        if high:
            keys, size = _until(keys, by, high[2], or_at=False), high[0]
        if low:
            keys, size, before = _from(keys, by, low[2], or_at=False), size - low[1], before + low[1]


def rows_between(df: DataFrame, order: Sequence[Column | By], limit: int, offset: int = 0, deep: int = DEEP) -> DataFrame:
    """Rows ``offset .. offset + limit`` of ``df`` in the given order: a top-k, for any k.

    Every task sends its first k rows to the one that merges them. Beyond a k of ``deep`` an order given as
    ``By`` columns finds the ends of the page first (``place_of``, which reads the sort columns a few
    times, at once), so that the rows before it are not moved at all, nor those behind a long one.
    ``order`` should end in a key.
    """
    by = [o for o in order if isinstance(o, By)]
    sort = [o.order if isinstance(o, By) else o for o in order]
    if offset + limit <= deep or len(by) < len(order):
        return df.orderBy(*sort).offset(offset).limit(limit)
    page = df
    if offset:
        first = place_of(df, by, offset)
        if first is None:
            return df.limit(0)
        page, offset = _from(df, by, first.at, or_at=True), offset - first.before
    if limit <= deep:
        return page.orderBy(*sort).offset(offset).limit(limit)
    last = place_of(page, by, offset + limit - 1)
    if last is None:
        return page.orderBy(*sort).offset(offset)
    page = _until(page, by, last.at, or_at=True).orderBy(*sort)
    if offset == 0 and last.upto == limit:
        return page
    return page.offset(offset).limit(limit)


def assign_ids(new_rows: DataFrame, order: Sequence[Column], last_id: int, name: str = "id") -> DataFrame:
    """Surrogate ids ``last_id + 1 ..`` for rows that are about to be inserted."""
    return with_row_index(new_rows, order, name).withColumn(
        name, F.col(name) + F.lit(last_id + 1).cast("bigint")
    )
