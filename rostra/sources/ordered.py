"""Globally ordered tables: files in order, and rows in order within each.

Rows are dealt to files by ranges of all sort columns, so a value that many rows share is
cut further by the columns after it, and no file has to hold all of its rows. Reading the
files one after the other gives the order; readers that want less of it skip files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.sources.tables import write_table


def ordering(*columns: str) -> list[Column]:
    """Sort keys from names; a leading minus means descending. NULLs are the smallest values."""
    return [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_first() for c in columns
    ]


def write_ordered(
    rows: DataFrame, path: str, *columns: str, files: int | None = None, require_rows: bool = True
) -> int:
    """Replace the table at ``path`` by the rows, sorted by ``columns``, and return their number.

    Give columns that together tell rows apart, or rows that agree in all of them share a
    file. ``files`` is the number of ranges, by default that of shuffle partitions.
    """
    keys = ordering(*columns)
    count = files or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
    return write_table(placed, path, require_rows)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with ``file`` and ``place``; sorted by these two they are in order.

    Names of part files begin with the number of their range.
    """
    rows = spark.read.parquet(path)
    return rows.select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place")
    )
