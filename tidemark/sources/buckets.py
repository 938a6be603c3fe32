"""Parquet folders that are bucketed by a key, so that a join on it moves only the other side.

Spark keeps the number of buckets in a catalog, not in the files. A folder is therefore known to the session's
catalog under a name made from its path; a session that does not know it yet is told from the declared schema.
The files are written as for any external table: without the catalog they remain a plain Parquet folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType


def _name(folder: str) -> str:
    return f"tidemark_{hashlib.md5(folder.encode()).hexdigest()}"


def write_bucketed(
    df: DataFrame,
    folder: str,
    keys: Sequence[str],
    buckets: int,
    partition_by: Sequence[str] = (),
    marked: bool = True,
    dealt: bool = False,
) -> None:
    """Write ``df`` to ``folder`` in ``buckets`` by ``keys``. Without ``marked`` no ``_SUCCESS`` is left.

    Rows are dealt to their buckets first, so that a bucket is one file (for each partition). What comes from a
    join of a bucketed folder on its keys is ``dealt`` already: each task writes its own bucket."""
    rows = (df if dealt else df.repartition(buckets, *keys)).write.format("parquet")
    if partition_by:
        rows = rows.partitionBy(*partition_by)
    rows = rows.bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).mode("overwrite")
    rows.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(marked).lower()).saveAsTable(_name(folder))


def read_bucketed(
    spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str], buckets: int, partition_by: Sequence[str] = ()
) -> DataFrame:
    """The folder with its buckets."""
    name = _name(folder)
    if not spark.catalog.tableExists(name):
        fields = StructType([StructField(f.name, f.dataType) for f in schema.fields]).toDDL()
        split = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        by = ", ".join(keys)
        location = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING parquet {split} CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        if partition_by:
            spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*schema.fieldNames())


def forget(spark: SparkSession, folder: str) -> None:
    """Take the folder out of the catalog; its files are not touched."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(folder)}")
