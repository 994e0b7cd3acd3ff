"""Parsed documents and the dimensional model built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.functions.common import beginning, date_key, hashed_key, name_key, period_label
from rostra.functions.dates import best_publication_date
from rostra.functions.metadata import parse_metadata_xml

# Names of the rule-based extractor and of the "no such entry" member.
RULE_EXTRACTOR = "rule_based_metadata_title_ocr"
RULE_EXTRACTOR_VERSION = "1"
UNKNOWN = "Unknown"

# Columns of a date.
DATE_COLUMNS = [
    "publication_year",
    "publication_month",
    "publication_day",
    "publication_date",
    "date_precision",
    "date_calendar",
]


def parse_metadata(bronze_metadata: DataFrame) -> DataFrame:
    return bronze_metadata.select(
        "document_id",
        F.col("file_path").alias("metadata_file_path"),
        parse_metadata_xml("raw_metadata_xml").alias("parsed"),
    ).select("document_id", "metadata_file_path", "parsed.*")


def parsed_documents(
    bronze_metadata: DataFrame, bronze_ocr_text: DataFrame, front_matter: int | None = None
) -> DataFrame:
    """Metadata with the OCR front matter, the rule-based date and its key.

    ``front_matter`` is the number of characters of a text that are searched for a date,
    all of them by default; only they cross the join, which reuses the exchange of the
    aggregate. Of several texts of a document the smallest front matter counts.
    """
    beginnings = (
        bronze_ocr_text.select(
            "document_id", beginning(F.col("raw_text"), front_matter).alias("ocr_front_matter")
        )
        .groupBy("document_id")
        .agg(F.min("ocr_front_matter").alias("ocr_front_matter"))
        .withColumn("has_ocr_text", F.lit(True))
    )
    date = best_publication_date("publication_date_raw", "title", "ocr_front_matter")
    dated = (
        parse_metadata(bronze_metadata)
        .join(beginnings, "document_id", "left")
        .withColumns(
            {
                "has_ocr_text": F.coalesce("has_ocr_text", F.lit(False)),
                "document_id_matches_metadata": F.col("document_id")
                == F.col("metadata_document_id"),
                "parsed_date": date,
            }
        )
    )
    return (
        dated.select("*", "parsed_date.*")
        .drop("parsed_date")
        .withColumnRenamed("date_parse_confidence", "date_confidence")
        .withColumn(
            "date_key",
            date_key(
                F.col("publication_year"),
                F.col("publication_month"),
                F.col("publication_day"),
                F.col("date_precision"),
                F.col("date_calendar"),
            ),
        )
    )


def dim_documents(parsed: DataFrame) -> DataFrame:
    # Columns of the document dimension, in order.
    return parsed.select(
        "document_id",
        "metadata_document_id",
        "document_id_matches_metadata",
        "date_key",
        "title",
        "creator",
        "author",
        "publication_date_raw",
        "date_source",
        "date_confidence",
        "date_parse_notes",
        "language",
        "internet_archive_id",
        "source_url",
        "has_ocr_text",
        "ocr_front_matter",
        "metadata_parse_status",
        "metadata_parse_error",
        "metadata_file_path",
    )


def dim_dates(dated: DataFrame) -> DataFrame:
    """One row per distinct date among rows that carry ``date_key`` and date columns."""
    dates = dated.select("date_key", *DATE_COLUMNS).distinct()
    # Names of the label and flags.
    return dates.select(
        "*",
        period_label(F.col("publication_year"), F.col("publication_month")).alias("period_label"),
        F.col("publication_year").isNotNull().alias("has_publication_year"),
        F.col("publication_month").isNotNull().alias("has_publication_month"),
        F.col("publication_day").isNotNull().alias("has_publication_day"),
    )


def _entries(names: F.Column, source: str) -> F.Column:
    """Array of (position, name, source) entries."""
    return F.transform(
        names,
        lambda name, i: F.struct(
            i.alias("position"), name.alias("name"), F.lit(source).alias("source")
        ),
    )


def _or_unknown(entries: F.Column) -> F.Column:
    unknown = F.array(
        F.struct(
            F.lit(0).alias("position"),
            F.lit(UNKNOWN).alias("name"),
            F.lit("unknown").alias("source"),
        )
    )
    return F.when(F.size(entries) > 0, entries).otherwise(unknown)


def creator_entries(parsed: DataFrame) -> DataFrame:
    """Creators and authors of each document, or one ``Unknown``; one pass, one explode."""
    entries = F.concat(
        _entries(F.col("creators"), "creator"), _entries(F.col("metadata_authors"), "author")
    )
    return (
        parsed.select("document_id", _or_unknown(entries).alias("entries"))
        .select("document_id", F.inline("entries"))
        .select(
            "document_id",
            F.col("position").alias("creator_position"),
            F.col("name").alias("creator_name"),
            F.col("source").alias("creator_source"),
            name_key(F.col("name")).alias("creator_id"),
        )
    )


def subject_entries(parsed: DataFrame) -> DataFrame:
    entries = _or_unknown(_entries(F.col("subjects"), "metadata_subject"))
    return (
        parsed.select("document_id", entries.alias("entries"))
        .select("document_id", F.inline("entries"))
        .select(
            "document_id",
            F.col("position").alias("subject_position"),
            F.col("name").alias("subject"),
            F.col("source").alias("subject_source"),
            name_key(F.col("name")).alias("subject_id"),
        )
    )


def dim_creators(entries: DataFrame) -> DataFrame:
    """One name per id. Spellings that differ only in case share an id; the smallest
    one names it, so joins through the id cannot multiply rows."""
    return entries.groupBy("creator_id").agg(F.min("creator_name").alias("creator_name"))


def dim_subjects(entries: DataFrame) -> DataFrame:
    return entries.groupBy("subject_id").agg(F.min("subject").alias("subject"))


def bridge_creators(entries: DataFrame) -> DataFrame:
    return entries.select(
        "document_id", "creator_id", "creator_source", "creator_position"
    ).distinct()


def bridge_subjects(entries: DataFrame) -> DataFrame:
    return entries.select(
        "document_id", "subject_id", "subject_source", "subject_position"
    ).distinct()


def extraction_input(date_raw: F.Column, title: F.Column, front_matter: F.Column) -> F.Column:
    """Text given to a date extractor; also the excerpt kept with each candidate.

    The labels are fixed values: stored excerpts have them.
    """
    return F.concat(
        F.lit("Metadata date: "), F.coalesce(date_raw, F.lit("")),
        F.lit("\nTitle: "), F.coalesce(title, F.lit("")),
        F.lit("\nOCR front matter: "),
        F.coalesce(front_matter, F.lit("")),
    )


# Columns of a date candidate.
CANDIDATE_COLUMNS = [
    "date_candidate_id",
    "document_id",
    "extractor_name",
    "extractor_version",
    "candidate_source_field",
    "candidate_publication_year",
    "candidate_publication_month",
    "candidate_publication_day",
    "candidate_publication_date",
    "candidate_date_precision",
    "candidate_date_calendar",
    "candidate_confidence",
    "candidate_confidence_score",
    "candidate_evidence",
    "raw_extraction",
    "source_text_excerpt",
    "selected_for_document",
]


def rule_date_candidates(parsed: DataFrame, excerpt_characters: int | None = None) -> DataFrame:
    """One rule-based candidate per document, in the schema all candidates share. The
    excerpt kept with it is whole unless a number of characters is given."""
    excerpt = extraction_input(
        F.col("publication_date_raw"), F.col("title"), F.col("ocr_front_matter")
    )
    return parsed.select(
        hashed_key(
            F.col("document_id"),
            F.lit("rule_based_selected"),
            F.coalesce("date_source", F.lit("unknown")),
        ).alias("date_candidate_id"),
        "document_id",
        F.lit(RULE_EXTRACTOR).alias("extractor_name"),
        F.lit(RULE_EXTRACTOR_VERSION).alias("extractor_version"),
        F.col("date_source").alias("candidate_source_field"),
        F.col("publication_year").alias("candidate_publication_year"),
        F.col("publication_month").alias("candidate_publication_month"),
        F.col("publication_day").alias("candidate_publication_day"),
        F.col("publication_date").alias("candidate_publication_date"),
        F.col("date_precision").alias("candidate_date_precision"),
        F.col("date_calendar").alias("candidate_date_calendar"),
        F.col("date_confidence").alias("candidate_confidence"),
        F.lit(None).cast("double").alias("candidate_confidence_score"),
        F.col("date_parse_notes").alias("candidate_evidence"),
        F.lit(None).cast("string").alias("raw_extraction"),
        beginning(excerpt, excerpt_characters).alias("source_text_excerpt"),
        F.lit(True).alias("selected_for_document"),
    )


def fact_documents(parsed: DataFrame) -> DataFrame:
    parsed_ok = F.col("metadata_parse_status") == "success"
    has_year = F.col("publication_year").isNotNull()
    # Names and rules of the document flags.
    return parsed.select(
        "document_id",
        "date_key",
        "has_ocr_text",
        has_year.alias("has_valid_publication_year"),
        F.col("publication_month").isNotNull().alias("has_publication_month"),
        F.col("publication_day").isNotNull().alias("has_publication_day"),
        parsed_ok.alias("metadata_parse_success_flag"),
        (has_year & parsed_ok & F.col("has_ocr_text")).alias("included_in_analysis_flag"),
    )
