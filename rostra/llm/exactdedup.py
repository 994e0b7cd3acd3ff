"""Exact dedup against a persistent index of text digests.

The index is a table of digests, bucketed and sorted by them. A new batch is reduced to
one row per digest, those already there go in a sort-merge anti-join, and the rest is
appended. The index is neither rewritten nor shuffled for that: its buckets meet the
batch's rows, which are dealt to the same buckets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.sources.tables import materialize

BUCKETS = 64
# Fixed value: characters that do not count when texts are compared.
_IGNORED = " \t\n\x0b\x0c\r"


def digest(text: Column) -> Column:
    """SHA-256 of a text without ASCII white space; a null text counts as empty."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), _IGNORED, "").cast("binary"), 256))


class DigestIndex:
    """First-seen digests under a folder of shared storage, which outlives the session."""

    def __init__(self, spark: SparkSession, location: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.table = f"digests_{hashlib.md5(location.encode()).hexdigest()}"
        quoted = location.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, keep_chars INT) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{quoted}'"
        )

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Append the digests that are new and decide on every row of the batch.

        Returns one row per row: ``doc_id`` (a number), ``keep_id``, ``group_size`` (rows
        of the batch with this text), ``kept`` and ``text_sha256``. Of equal texts in a
        batch the row with the most code points stays, then that of the smallest id, a
        null id last, then any one of rows that agree in both. A text whose digest the
        index had before is not kept again, unless it is the very row that was kept: a
        batch that is added again, after a failure or not, gets the same decisions.
        """
        rows = materialize(
            docs.select(
                F.col(doc_id).cast("long").alias("doc_id"),
                digest(F.col(text)).alias("digest"),
                F.length(F.coalesce(F.col(text), F.lit(""))).alias("chars"),
                F.monotonically_increasing_id().alias("row"),
            )
        )
        order = F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row").alias("row"))
        groups = materialize(
            rows.groupBy("digest")
            .agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best"), F.max("chars").alias("chars"))
            .select("digest", "group_size", "chars", F.col("best.id").alias("id"), F.col("best.row").alias("best"))
        )
        new = groups.join(self.read().hint("merge"), "digest", "left_anti")
        (
            new.select("digest", F.col("id").alias("keep_id"), F.col("chars").alias("keep_chars"))
            # By the hash that buckets go by: a bucket lies in one task, and is one file,
            # whatever the number of partitions.
            .repartition(self.buckets, F.pmod(F.hash("digest"), F.lit(self.buckets)))
            .write.mode("append")
            .insertInto(self.table)
        )
        same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
        decided = materialize(
            groups.join(self.read().hint("merge"), "digest").select(
                "digest", "group_size", "keep_id", F.when(same, F.col("best")).alias("best")
            )
        )
        # One digest may hold a third of the rows: both sides are shuffled here, so that
        # Spark can split it.
        return rows.join(decided, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("row").eqNullSafe(F.col("best")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
