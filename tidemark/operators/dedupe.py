"""One row per key, and the first rows of each group.

Both are ``row_number() <= n`` filters, which Spark also applies before the shuffle
(``WindowGroupLimit``): a task sends at most ``n`` rows of a key, however hot the key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def dedupe_last(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], strict: bool = False
) -> DataFrame:
    """Keep the last row per key by ``order_by``.

    ``order_by`` is normally the arrival position; event-time columns give event-time order.
    ``strict=True`` raises on a repeated key instead of choosing.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in order_by]
    if not strict:
        return _ranked(df, keys, newest_first, 1, "_rank").drop("_rank")
    seen = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    repeated = F.raise_error(F.concat(F.lit("repeated key in batch: "), seen))
    return (
        _ranked(df, keys, newest_first, 2, "_rank")
        .where(F.when(F.col("_rank") > 1, repeated.cast("boolean")).otherwise(F.lit(True)))
        .drop("_rank")
    )


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "pos") -> DataFrame:
    """The first ``n`` rows of each group in ``order``, with their 1-based place."""
    return _ranked(df, keys, order, n, name)
