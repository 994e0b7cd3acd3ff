"""Restriction of a corpus to a list of document ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what a document id may look like.
DOCUMENT_ID = r"^[A-Za-z0-9._-]+$"


def manifest_ids(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct ids of a one-id-per-line listing, blank lines dropped."""
    return (
        lines.select(F.trim(F.col(column).cast("string")).alias("document_id"))
        .where(F.col("document_id") != "")
        .distinct()
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a manifest file; raises on an empty manifest or an id of another form."""
    ids = manifest_ids(spark.read.text(path))
    counts = ids.agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if(~F.col("document_id").rlike(DOCUMENT_ID)).alias("bad"),
    ).first()
    if counts["all"] == 0:
        raise ValueError("the manifest is empty")
    if counts["bad"]:
        raise ValueError(f"{counts['bad']} manifest ids are not valid")
    return ids


def restrict_to_manifest(documents: DataFrame, ids: DataFrame) -> DataFrame:
    return documents.join(ids, "document_id", "left_semi")
