"""Landed response pages: read, unwrap, project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENVELOPE, ITEM, ITEM_FIELDS


# Arrival order of items: when the file was written, file, split of the file, page in the split,
# place on the page.
ARRIVAL = ["landed", "page", "block", "line", "pos"]


def _with_origin(pages: DataFrame) -> DataFrame:
    return pages.select(
        "*",
        F.col("_metadata.file_modification_time").alias("landed"),
        F.col("_metadata.file_path").alias("page"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _options(lines: bool) -> dict[str, str]:
    return {
        "multiLine": str(not lines).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt_record",
    }


def read_pages(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Response pages with the file and split each came from.

    One page per file by default. ``lines=True`` reads one page per line; such files are split
    between tasks, so use it for large landings.
    """
    return _with_origin(spark.read.schema(ENVELOPE).options(**_options(lines)).json(path))


def stream_pages(spark: SparkSession, path: str, lines: bool = False, **source_options: str) -> DataFrame:
    """The same frame as ``read_pages``, as a stream of the files that arrive.

    Items are taken from it batch by batch: pass ``extract_items`` as ``prepare`` to the run.
    """
    reader = spark.readStream.schema(ENVELOPE).options(**_options(lines), **source_options)
    return _with_origin(reader.json(path))


def _readable(pages: DataFrame) -> Column:
    """The items of a page as texts; NULL for a page that is not JSON or whose ``data`` is no array."""
    return F.when(F.col("_corrupt_record").isNull(), F.col("data"))


def _parsed(item: Column) -> Column:
    """An item's fields; NULL for what is not an object. (A string that is an object's JSON passes for one.)"""
    return F.when(F.startswith(item, F.lit("{")) & F.endswith(item, F.lit("}")), F.from_json(item, ITEM))


def _is_odd(item: Column) -> Column:
    """What stands among the items and is neither an object nor NULL, which is an item without fields."""
    fields = _parsed(item)
    return item.isNotNull() & (fields.isNull() | fields["_corrupt_record"].isNotNull())


def parsed_pages(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per page: where it comes from, whether it is ``bad``, its ``items`` (place and fields) and
    the numbers of good items, of bad ones and of sizes that are no whole number.

    Everything else about a landing follows from this, so a run that keeps it reads and parses the pages
    once, and tells the same when it is resumed. ``limit`` keeps the first items of each page; the
    numbers are of all.
    """
    # within one split the ids rise in reading order, whichever task reads it
    placed = pages.select(
        "landed",
        "page",
        "block",
        F.monotonically_increasing_id().alias("line"),
        F.col("_corrupt_record").isNotNull().alias("bad"),
        F.transform(_readable(pages), lambda t, i: F.struct(i.alias("pos"), _is_odd(t).alias("odd"), _parsed(t).alias("item"))).alias("data"),
    )
    size = lambda x: x["item"]["file_size"]
    not_whole = lambda x: size(x).isNotNull() & size(x).try_cast("bigint").isNull()
    first = F.col("data") if limit is None else F.slice("data", 1, limit)
    count = lambda test: F.coalesce(F.array_size(F.filter("data", test)), F.lit(0)).cast("bigint")
    return placed.select(
        "landed",
        "page",
        "block",
        "line",
        "bad",
        F.transform(F.filter(first, lambda x: ~x["odd"]), lambda x: x.dropFields("odd")).alias("items"),
        count(lambda x: ~x["odd"]).alias("n_items"),
        count(lambda x: x["odd"]).alias("n_odd"),
        count(not_whole).alias("n_sizes"),
    )


def items_of(parsed: DataFrame) -> DataFrame:
    """The items of ``parsed_pages``: the six fields and the columns of ``ARRIVAL``."""
    items = parsed.select("landed", "page", "block", "line", F.explode("items").alias("x")).select("landed", "page", "block", "line", "x.*")
    fields = [F.col(f"item.{source}").alias(name) for source, name in ITEM_FIELDS.items()]
    return items.select(*ARRIVAL, *fields).withColumn("file_size", F.col("file_size").try_cast("bigint"))


def extract_items(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """Items of all readable pages: the six fields and the columns of ``ARRIVAL``.

    A page without ``data``, or one that is not JSON, gives no items. ``limit`` keeps the first
    items of each page. Bad items are left out (``page_metrics`` counts them); NULL is an
    item without fields. ``file_size`` becomes NULL where it is not a whole number.
    """
    return items_of(parsed_pages(pages, limit))


def metrics_of(parsed: DataFrame, files: int | None = None) -> DataFrame:
    """``page_metrics`` of ``parsed_pages``."""
    seen, zero = F.count("*"), F.lit(0).cast("bigint")
    total = seen if files is None else F.lit(files).cast("bigint")
    return parsed.agg(
        total.alias("pages"),
        (F.count_if("bad") + total - seen).alias("bad_pages"),
        F.coalesce(F.sum("n_items"), zero).alias("items"),
        F.coalesce(F.sum("n_sizes"), zero).alias("bad_sizes"),
        F.coalesce(F.sum("n_odd"), zero).alias("bad_items"),
    )


def page_metrics(pages: DataFrame, files: int | None = None) -> DataFrame:
    """pages, bad_pages, and the items, bad_sizes and bad_items on the readable ones, in one row.

    What is neither an object nor NULL is a bad item and no item. A size that is not a whole number is
    loaded as NULL and counted in bad_sizes. A zero-length file yields no row at all. Give the number of listed files
    (``listed_files``) for one-page-per-file landings, and the files without a row count as bad pages too.
    """
    return metrics_of(parsed_pages(pages), files)


def listed_files(pages: DataFrame) -> int:
    """Number of files in the listing behind a page frame, empty ones included. The names stay in the JVM,
    where the listing is anyway."""
    return len(pages._jdf.inputFiles())
