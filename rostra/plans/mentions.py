"""Mention facts: found mentions with document dates and lexicon attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.operators.joins import join_star_left
from rostra.plans.documents import DATE_COLUMNS


def fact_mentions(
    found: DataFrame,
    documents: DataFrame,
    dates: DataFrame,
    fact_documents: DataFrame,
    figures: DataFrame,
    variants: DataFrame,
) -> DataFrame:
    """One row per mention of ``find_mentions``. Dates and facts meet per document
    first, so the mentions themselves are joined to documents once."""
    per_document = join_star_left(
        documents.select("document_id", "date_key"),
        (dates.select("date_key", *DATE_COLUMNS), "date_key"),
        (
            fact_documents.select("document_id", "ocr_quality_flag", "included_in_analysis_flag"),
            "document_id",
        ),
    )
    rows = join_star_left(
        found,
        (per_document, "document_id"),
        (figures.select("figure_id", "canonical_name"), "figure_id"),
        (variants.select("variant_id", "variant_type", "match_confidence"), "variant_id"),
    )
    ready = (
        F.col("included_in_analysis_flag")
        & F.col("publication_year").isNotNull()
        & F.col("figure_id").isNotNull()
    )
    return rows.select(
        "mention_id",
        "document_id",
        "figure_id",
        "variant_id",
        "date_key",
        "canonical_name",
        "matched_variant",
        "variant_normalized",
        "variant_type",
        "match_confidence",
        (F.col("match_confidence") == "high").alias("is_high_confidence_match"),
        "match_method",
        "match_start_char",
        "match_end_char",
        *DATE_COLUMNS,
        "ocr_quality_flag",
        "included_in_analysis_flag",
        ready.alias("is_analysis_ready"),
    )
