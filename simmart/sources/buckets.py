"""Catalog tables stored in sorted buckets of their key, so that loads join them without moving what is stored.

A table created here is used like any other: ``append_table``, ``refresh_table`` and the mart loads find its buckets in
the catalog and keep them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from simmart.session import empty

CODEC = "zstd"


def create_buckets(
    spark: SparkSession, table: str, schema: T.StructType, key: list[str], buckets: int, path: str | None = None
) -> None:
    """An empty table in ``buckets`` buckets of ``key``, at ``path`` or in the warehouse. An existing one is an error.

    Joins need no exchange of the table when they use all columns of the key, so a fact with pairs as key takes both ids.
    Tables that meet on one column should have the same number of buckets. Choose the number for the size to come:
    a bucket is read by one task, and every load adds one file to each bucket with new rows.
    """
    if buckets < 1 or not key or set(key) - set(schema.names):
        raise ValueError("buckets is at least 1, key names columns of the schema")
    writer = bucketed(empty(spark, schema), buckets, key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """Number of buckets and key of a catalog table, or None when it has none."""
    if not any(c.isBucket for c in spark.catalog.listColumns(table)):
        return None
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return int(told["Num Buckets"]), re.findall("`([^`]+)`", told["Bucket Columns"])


def bucketed(df: DataFrame, buckets: int, key: list[str]) -> DataFrameWriter:
    """A writer of rows that have met in their bucket: each bucket with rows gets one sorted file."""
    return df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).option("compression", CODEC)
