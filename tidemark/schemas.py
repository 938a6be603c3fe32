"""Declared schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The item fields as the response names them, and as the table names them.
ITEM_FIELDS = {
    "id": "wallhaven_id",
    "path": "url",
    "resolution": "resolution",
    "category": "category",
    "purity": "purity",
    "file_size": "file_size",
}
ITEM_KEY = "wallhaven_id"
LOAD_COLUMNS = list(ITEM_FIELDS.values())

# An item stays the text that it is on its page until it is taken apart, so that an odd one costs its page
# nothing. Every field is read as a string: a quoted file_size under a bigint field would make its item bad.
ENVELOPE = StructType([StructField("data", ArrayType(StringType())), StructField("_corrupt_record", StringType())])
ITEM = StructType([*[StructField(name, StringType()) for name in ITEM_FIELDS], StructField("_corrupt_record", StringType())])

WALLPAPERS_SCHEMA = StructType(
    [
        StructField("wallhaven_id", StringType(), False),
        StructField("url", StringType(), False),
        StructField("resolution", StringType()),
        StructField("category", StringType()),
        StructField("purity", StringType()),
        StructField("file_size", LongType()),
        StructField("s3_key", StringType()),
        StructField("created_at", TimestampType(), False),
        StructField("updated_at", TimestampType()),
    ]
)

RUN_COUNTERS = [
    "metadata_inserted",
    "metadata_updated",
    "images_uploaded",
    "download_failures",
    "upload_failures",
    "missing_s3_after_run",
]

RUN_AUDIT_SCHEMA = StructType(
    [
        StructField("dag_id", StringType(), False),
        StructField("run_id", StringType(), False),
        StructField("logical_date", TimestampType()),
        StructField("started_at", TimestampType()),
        StructField("ended_at", TimestampType()),
        StructField("duration_seconds", LongType()),
        *[StructField(name, LongType(), False) for name in RUN_COUNTERS],
        StructField("notes", StringType()),
        StructField("created_at", TimestampType(), False),
        StructField("updated_at", TimestampType(), False),
    ]
)

# Column of the folder names of a table with pending rows.
PENDING = StructField("pending", BooleanType())


@dataclass(frozen=True)
class TableSpec:
    """What an upsert has to know about a keyed table.

    ``update_cols`` are replaced by the batch; ``insert_stamps`` and ``update_stamps`` take the
    run's timestamp when a row is inserted or matched; everything else is kept.
    ``pending_col`` is NULL in rows that wait to be published; those get files of their own.
    With ``buckets`` the versions of a table are bucketed by its keys, so that a merge moves only the
    batch, however large it is; as many buckets as a join of the table should have tasks.
    """

    schema: StructType
    keys: tuple[str, ...]
    update_cols: tuple[str, ...]
    insert_stamps: tuple[str, ...] = ()
    update_stamps: tuple[str, ...] = ()
    pending_col: str | None = None
    buckets: int = 0

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def typed(self, name: str) -> Column:
        """A column as the table declares it."""
        return F.col(name).cast(self.schema[name].dataType).alias(name)


WALLPAPERS = TableSpec(
    schema=WALLPAPERS_SCHEMA,
    keys=(ITEM_KEY,),
    update_cols=tuple(c for c in LOAD_COLUMNS if c != ITEM_KEY),
    insert_stamps=("created_at",),
    update_stamps=("updated_at",),
    pending_col="s3_key",
)

RUN_AUDIT = TableSpec(
    schema=RUN_AUDIT_SCHEMA,
    keys=("dag_id", "run_id"),
    update_cols=("logical_date", "started_at", "ended_at", "duration_seconds", *RUN_COUNTERS),
    insert_stamps=("created_at", "updated_at"),
    update_stamps=("updated_at",),
)
