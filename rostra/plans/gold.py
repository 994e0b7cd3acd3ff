"""Gold tables: mentions and stance by period, document, creator and subject, and
ranked evidence passages.

All of them first aggregate per document. Map-side combining then shrinks the data
before every shuffle, also when one figure or period holds most of the rows, and
distinct document counts become plain row counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.functions.common import packed_digest, unpacked_digest, vocabulary_rank
from rostra.functions.measures import (
    count_when,
    document_label,
    exact_sum,
    is_included,
    mean,
    safe_ratio,
)
from rostra.operators.joins import join_bridge_expand, join_star_left
from rostra.operators.ranking import ranked_in_groups
from rostra.plans.documents import DATE_COLUMNS, UNKNOWN
from rostra.sources.tables import materialize

# Fixed values, down to the shares: names of keys, attributes and measures of the gold tables.
PERIOD = ["period_label", "publication_year", "publication_month"]
FIGURE = ["figure_id", "canonical_name"]

DOCUMENT_ATTRIBUTES = [
    "title",
    "creator",
    "author",
    "language",
    "internet_archive_id",
    "source_url",
    "metadata_parse_status",
]

# Counts every stance table has.
LABEL_COUNTS = [
    "positive_mention_count",
    "negative_mention_count",
    "neutral_or_unclear_mention_count",
]
INTENSITY_COUNTS = [
    "weak_stance_mention_count",
    "moderate_stance_mention_count",
    "strong_stance_mention_count",
    "strong_negative_mention_count",
]
CONFIDENCE_COUNTS = [
    "high_confidence_count",
    "medium_confidence_count",
    "low_confidence_count",
]
RELEVANCE_COUNTS = ["direct_mention_count", "indirect_mention_count", "not_relevant_mention_count"]
INCLUDED_RELEVANCE_COUNTS = [f"included_{name}" for name in RELEVANCE_COUNTS]
MENTION_COUNTS = [
    "mention_count",
    "included_mention_count",
    *LABEL_COUNTS,
    *INTENSITY_COUNTS,
    *CONFIDENCE_COUNTS,
    *RELEVANCE_COUNTS,
    *INCLUDED_RELEVANCE_COUNTS,
]
MENTION_SHARES = {
    "included_mention_share": ("included_mention_count", "mention_count"),
    "positive_mention_share": ("positive_mention_count", "included_mention_count"),
    "negative_mention_share": ("negative_mention_count", "included_mention_count"),
    "neutral_or_unclear_mention_share": (
        "neutral_or_unclear_mention_count",
        "included_mention_count",
    ),
    "strong_negative_mention_share": ("strong_negative_mention_count", "included_mention_count"),
    "direct_relevance_share": ("included_direct_mention_count", "included_mention_count"),
}


def stance_rows(mentions: DataFrame, dates: DataFrame, categories: DataFrame) -> DataFrame:
    """Mentions with the dates of the date dimension and their stance category."""
    rows = join_star_left(
        mentions.drop(*DATE_COLUMNS),
        (dates.select("date_key", "period_label", *DATE_COLUMNS), "date_key"),
        (
            categories.select(
                "stance_category_id",
                "stance_label",
                "stance_intensity",
                "stance_confidence",
                "target_relevance",
            ),
            "stance_category_id",
        ),
    )
    return rows.withColumn(
        "is_included", is_included(F.col("stance_confidence"), F.col("stance_score"))
    )


def _mention_counts() -> list[Column]:
    included = F.col("is_included")
    label, intensity = F.col("stance_label"), F.col("stance_intensity")
    confidence, relevance = F.col("stance_confidence"), F.col("target_relevance")
    counts = {"mention_count": F.count(F.lit(1)), "included_mention_count": count_when(included)}
    for value in ("positive", "negative", "neutral_or_unclear"):
        counts[f"{value}_mention_count"] = count_when(included & (label == value))
    for value in ("weak", "moderate", "strong"):
        counts[f"{value}_stance_mention_count"] = count_when(included & (intensity == value))
    counts["strong_negative_mention_count"] = count_when(
        included & (label == "negative") & (intensity == "strong")
    )
    for value in ("high", "medium", "low"):
        counts[f"{value}_confidence_count"] = count_when(confidence == value)
    for value in ("direct", "indirect", "not_relevant"):
        counts[f"{value}_mention_count"] = count_when(relevance == value)
        counts[f"included_{value}_mention_count"] = count_when(included & (relevance == value))
    return [counts[name].alias(name) for name in MENTION_COUNTS]


def _score_sums() -> list[Column]:
    score = F.when(F.col("is_included"), F.col("stance_score"))
    return [exact_sum(score).alias("score_sum"), exact_sum(F.abs(score)).alias("abs_score_sum")]


def _date_span() -> list[Column]:
    return [
        F.min("publication_date").alias("min_publication_date"),
        F.max("publication_date").alias("max_publication_date"),
    ]


def _shares(names: dict[str, tuple[str, str]]) -> dict[str, Column]:
    return {name: safe_ratio(top, bottom) for name, (top, bottom) in names.items()}


def figure_mentions_by_period(
    mentions: DataFrame, dates: DataFrame, categories: DataFrame
) -> DataFrame:
    keys = [*PERIOD, "date_precision", "date_calendar", *FIGURE, "match_confidence"]
    rows = stance_rows(mentions, dates, categories)
    included, ready = F.col("is_included"), F.col("is_analysis_ready")

    def included_with(column, value):
        return count_when(included & (F.col(column) == value))

    measures = {
        "mention_count": F.count(F.lit(1)),
        "high_confidence_match_count": count_when(F.col("is_high_confidence_match")),
        "analysis_ready_mention_count": count_when(ready),
        "included_stance_mention_count": count_when(included),
        **{
            f"{v}_mention_count": included_with("stance_label", v)
            for v in ("positive", "negative", "neutral_or_unclear")
        },
        **{
            f"{v}_stance_mention_count": included_with("stance_intensity", v)
            for v in ("weak", "moderate", "strong")
        },
        **{
            f"{v}_stance_confidence_count": count_when(F.col("stance_confidence") == v)
            for v in ("high", "medium", "low")
        },
        **{
            f"{v}_mention_count": count_when(F.col("target_relevance") == v)
            for v in ("direct", "indirect", "not_relevant")
        },
    }
    # Documents come first, which moves nothing where mentions lie by document. Each of them then counts once, and
    # once for every variant it has, so that variants are distinct after another aggregate of what is few by then.
    by_document = rows.groupBy(*keys, "document_id").agg(
        *[measure.alias(name) for name, measure in measures.items()],
        *_date_span(),
        F.collect_set("variant_id").alias("variants"),
    )
    sides = F.concat(F.array(F.lit(None).cast("string")), F.col("variants"))
    counted, has_document = F.col("variant").isNull(), F.col("document_id").isNotNull()
    documents = {
        "document_count": has_document,
        "analysis_ready_document_count": has_document & (F.col("analysis_ready_mention_count") > 0),
        "included_stance_document_count": has_document & (F.col("included_stance_mention_count") > 0),
    }
    members = by_document.withColumn("variant", F.explode(sides)).groupBy(*keys, "variant").agg(
        *[F.sum(F.when(counted, F.col(name))).alias(name) for name in measures],
        *[count_when(counted & condition).alias(name) for name, condition in documents.items()],
        F.min("min_publication_date").alias("min_publication_date"),
        F.max("max_publication_date").alias("max_publication_date"),
    )
    grouped = members.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in (*measures, *documents)],
        F.count("variant").alias("matched_variant_count"),
        F.min("min_publication_date").alias("min_publication_date"),
        F.max("max_publication_date").alias("max_publication_date"),
    )
    shares = _shares(
        {
            "included_stance_mention_share": ("included_stance_mention_count", "mention_count"),
            "positive_mention_share": ("positive_mention_count", "included_stance_mention_count"),
            "negative_mention_share": ("negative_mention_count", "included_stance_mention_count"),
            "neutral_or_unclear_mention_share": (
                "neutral_or_unclear_mention_count",
                "included_stance_mention_count",
            ),
        }
    )
    flags = {
        "is_high_confidence_match_group": F.col("match_confidence") == "high",
        "is_analysis_ready": F.col("publication_year").isNotNull()
        & (F.col("analysis_ready_mention_count") > 0),
    }
    return grouped.withColumns(shares | flags).select(
        *keys,
        "is_high_confidence_match_group",
        "is_analysis_ready",
        "mention_count",
        "document_count",
        "matched_variant_count",
        "high_confidence_match_count",
        "analysis_ready_mention_count",
        "analysis_ready_document_count",
        "included_stance_mention_count",
        "included_stance_document_count",
        "included_stance_mention_share",
        *LABEL_COUNTS,
        "positive_mention_share",
        "negative_mention_share",
        "neutral_or_unclear_mention_share",
        *INTENSITY_COUNTS[:3],
        "high_stance_confidence_count",
        "medium_stance_confidence_count",
        "low_stance_confidence_count",
        *RELEVANCE_COUNTS,
        "min_publication_date",
        "max_publication_date",
    )


def figure_stance_by_period(
    mentions: DataFrame,
    dates: DataFrame,
    categories: DataFrame,
    null_safe_keys: bool = True,
) -> DataFrame:
    """Mention- and document-weighted stance per period and figure.

    One aggregate per document feeds both weightings, so no self-join is needed.
    ``null_safe_keys=False`` leaves the document-weighted columns NULL for periods
    without a year or month, as an equality join on those keys would.
    """
    keys = [*PERIOD, *FIGURE]
    precisions = ["day", "month", "year"]
    rows = stance_rows(mentions, dates, categories)
    documents = (
        rows.groupBy(*keys, "document_id")
        .agg(
            *_mention_counts(),
            *_score_sums(),
            *[
                count_when(F.col("date_precision") == p).alias(f"{p}_precision_count")
                for p in precisions
            ],
            *_date_span(),
        )
        .withColumns(
            {
                "average": mean(F.col("score_sum"), F.col("included_mention_count")),
                "abs_average": mean(F.col("abs_score_sum"), F.col("included_mention_count")),
            }
        )
    )
    label = document_label(F.col("average"), F.col("included_mention_count"))
    summed = [*MENTION_COUNTS, *[f"{p}_precision_count" for p in precisions]]
    grouped = documents.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in summed],
        F.count("document_id").alias("document_count"),
        count_when(F.col("document_id").isNotNull() & (F.col("included_mention_count") > 0)).alias(
            "included_document_count"
        ),
        mean(F.sum("score_sum"), F.sum("included_mention_count")).alias(
            "avg_stance_score_mention_weighted"
        ),
        mean(F.sum("abs_score_sum"), F.sum("included_mention_count")).alias(
            "avg_abs_stance_score_mention_weighted"
        ),
        F.avg("average").alias("avg_stance_score_document_weighted"),
        F.avg("abs_average").alias("avg_abs_stance_score_document_weighted"),
        *[
            count_when(label == value).alias(f"{value}_document_count")
            for value in ("positive", "negative", "neutral")
        ],
        F.min("min_publication_date").alias("min_publication_date"),
        F.max("max_publication_date").alias("max_publication_date"),
    )
    document_columns = [
        "avg_stance_score_document_weighted",
        "avg_abs_stance_score_document_weighted",
        "positive_document_count",
        "negative_document_count",
        "neutral_document_count",
    ]
    if not null_safe_keys:
        known = F.col(keys[0]).isNotNull()
        for key in keys[1:]:
            known = known & F.col(key).isNotNull()
        grouped = grouped.withColumns({c: F.when(known, F.col(c)) for c in document_columns})
    shares = _shares(
        MENTION_SHARES | {"included_document_share": ("included_document_count", "document_count")}
    )
    return grouped.withColumns(
        shares
        | {
            "avg_stance_score": F.col("avg_stance_score_document_weighted"),
            "avg_abs_stance_score": F.col("avg_abs_stance_score_document_weighted"),
            "is_analysis_ready": F.col("publication_year").isNotNull()
            & (F.col("included_mention_count") > 0),
        }
    ).select(
        *keys,
        "is_analysis_ready",
        "mention_count",
        "document_count",
        "included_mention_count",
        "included_document_count",
        "included_mention_share",
        "included_document_share",
        "avg_stance_score",
        "avg_abs_stance_score",
        "avg_stance_score_document_weighted",
        "avg_stance_score_mention_weighted",
        "avg_abs_stance_score_document_weighted",
        "avg_abs_stance_score_mention_weighted",
        *LABEL_COUNTS,
        "positive_mention_share",
        "negative_mention_share",
        "neutral_or_unclear_mention_share",
        *INTENSITY_COUNTS,
        "strong_negative_mention_share",
        "positive_document_count",
        "negative_document_count",
        "neutral_document_count",
        *CONFIDENCE_COUNTS,
        *RELEVANCE_COUNTS,
        *INCLUDED_RELEVANCE_COUNTS,
        "direct_relevance_share",
        *[f"{p}_precision_count" for p in precisions],
        "min_publication_date",
        "max_publication_date",
    )


def figure_stance_by_document(
    mentions: DataFrame, documents: DataFrame, dates: DataFrame, categories: DataFrame
) -> DataFrame:
    """Stance per document and figure.

    Mentions are aggregated before documents and dates are attached: those depend
    on the document alone, so the joins run on one row per document and figure.
    """
    labelled = mentions.select(
        "document_id",
        *FIGURE,
        "date_key",
        "ocr_quality_flag",
        "stance_category_id",
        "stance_score",
    ).join(
        categories.select(
            "stance_category_id",
            "stance_label",
            "stance_intensity",
            "stance_confidence",
            "target_relevance",
        ),
        "stance_category_id",
        "left",
    )
    rows = labelled.withColumn(
        "is_included", is_included(F.col("stance_confidence"), F.col("stance_score"))
    )
    score = F.when(F.col("is_included"), F.col("stance_score"))
    grouped = rows.groupBy("document_id", *FIGURE).agg(
        F.max("date_key").alias("date_key"),
        F.max("ocr_quality_flag").alias("ocr_quality_flag"),
        *_mention_counts(),
        *_score_sums(),
        F.min(score).alias("min_stance_score"),
        F.max(score).alias("max_stance_score"),
    )
    attached = join_star_left(
        grouped,
        (
            documents.select(
                "document_id",
                *DOCUMENT_ATTRIBUTES,
                F.coalesce("conflicts_with_metadata_year", F.lit(False)).alias("_conflict"),
            ),
            "document_id",
        ),
        (dates.select("date_key", "period_label", *DATE_COLUMNS), "date_key"),
    )
    conflict = F.coalesce("_conflict", F.lit(False))
    averaged = attached.withColumns(
        {
            "avg_stance_score": mean(F.col("score_sum"), F.col("included_mention_count")),
            "avg_abs_stance_score": mean(F.col("abs_score_sum"), F.col("included_mention_count")),
        }
    )
    return averaged.withColumns(
        _shares(MENTION_SHARES)
        | {
            "has_metadata_year_conflict": conflict,
            "document_stance_label": document_label(
                F.col("avg_stance_score"), F.col("included_mention_count")
            ),
            "is_analysis_ready": F.col("publication_year").isNotNull()
            & (F.col("included_mention_count") > 0)
            & ~conflict,
        }
    ).select(
        "document_id",
        *FIGURE,
        *DOCUMENT_ATTRIBUTES,
        "period_label",
        *DATE_COLUMNS,
        "has_metadata_year_conflict",
        "ocr_quality_flag",
        "is_analysis_ready",
        "mention_count",
        "included_mention_count",
        "included_mention_share",
        "avg_stance_score",
        "avg_abs_stance_score",
        "min_stance_score",
        "max_stance_score",
        "document_stance_label",
        *LABEL_COUNTS,
        "positive_mention_share",
        "negative_mention_share",
        "neutral_or_unclear_mention_share",
        *INTENSITY_COUNTS,
        "strong_negative_mention_share",
        *CONFIDENCE_COUNTS,
        *RELEVANCE_COUNTS,
        *INCLUDED_RELEVANCE_COUNTS,
        "direct_relevance_share",
    )


def figure_stance_by_member(
    by_document: DataFrame,
    bridge: DataFrame,
    members: DataFrame,
    member_id: str,
    member_name: str,
    member_source: str,
    placed: bool = False,
) -> DataFrame:
    """Document stance re-aggregated per bridge member (creator, subject) and period.

    A document counts once for every member it has. Names are looked up after the
    aggregation, on a few rows, because the id already determines the group.
    """
    keys = [*PERIOD, member_id, member_source, *FIGURE]
    columns = [
        "document_id",
        *PERIOD,
        *FIGURE,
        "publication_date",
        "is_analysis_ready",
        "document_stance_label",
        "avg_stance_score",
        "avg_abs_stance_score",
        *MENTION_COUNTS,
    ]
    expanded = join_bridge_expand(
        by_document.select(*columns), bridge, [member_id, member_source], placed=placed
    ).withColumn(member_id, packed_digest(F.col(member_id)))
    weight, ready = F.col("member_weight"), F.col("is_analysis_ready")

    def weighted(condition):
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))

    def average(name):
        counted = ready & F.col(name).isNotNull()
        total = F.sum(F.when(counted, F.col(name) * weight))
        return total / F.nullif(weighted(counted), F.lit(0))

    label = F.col("document_stance_label")
    grouped = expanded.groupBy(*keys).agg(
        F.count("document_id").alias("document_count"),
        *[F.sum(F.col(name) * weight).alias(name) for name in MENTION_COUNTS],
        average("avg_stance_score").alias("avg_stance_score"),
        average("avg_abs_stance_score").alias("avg_abs_stance_score"),
        *[
            weighted(ready & (label == value)).alias(f"{value}_document_count")
            for value in ("positive", "negative", "neutral")
        ],
        weighted(ready).alias("analysis_ready_document_count"),
        weighted(~ready).alias("not_analysis_ready_document_count"),
        *_date_span(),
    )
    grouped = grouped.withColumn(member_id, unpacked_digest(F.col(member_id)))
    named = grouped.join(members.select(member_id, member_name), member_id, "left")
    shares = _shares(
        MENTION_SHARES
        | {"analysis_ready_document_share": ("analysis_ready_document_count", "document_count")}
    )
    return named.withColumns(
        shares
        | {
            member_name: F.coalesce(member_name, F.lit(UNKNOWN)),
            "is_analysis_ready": F.col("publication_year").isNotNull()
            & (F.col("analysis_ready_document_count") > 0),
        }
    ).select(
        *PERIOD,
        member_id,
        member_name,
        member_source,
        *FIGURE,
        "is_analysis_ready",
        "document_count",
        "analysis_ready_document_count",
        "not_analysis_ready_document_count",
        "analysis_ready_document_share",
        "mention_count",
        "included_mention_count",
        "included_mention_share",
        "avg_stance_score",
        "avg_abs_stance_score",
        "positive_document_count",
        "negative_document_count",
        "neutral_document_count",
        *LABEL_COUNTS,
        "positive_mention_share",
        "negative_mention_share",
        "neutral_or_unclear_mention_share",
        *INTENSITY_COUNTS,
        "strong_negative_mention_share",
        *CONFIDENCE_COUNTS,
        *RELEVANCE_COUNTS,
        *INCLUDED_RELEVANCE_COUNTS,
        "direct_relevance_share",
        "min_publication_date",
        "max_publication_date",
    )


def figure_stance_by_creator(
    by_document: DataFrame, bridge: DataFrame, creators: DataFrame, placed: bool = False
) -> DataFrame:
    return figure_stance_by_member(
        by_document, bridge, creators, "creator_id", "creator_name", "creator_source", placed
    )


def figure_stance_by_subject(
    by_document: DataFrame, bridge: DataFrame, subjects: DataFrame, placed: bool = False
) -> DataFrame:
    return figure_stance_by_member(
        by_document, bridge, subjects, "subject_id", "subject", "subject_source", placed
    )


# What the ranking and its result need of an evidence passage, before texts.
EVIDENCE_COLUMNS = [
    "stance_audit_id",
    "mention_id",
    "document_id",
    *FIGURE,
    "documents",
    "period_label",
    *DATE_COLUMNS,
    "matched_variant",
    "variant_type",
    "match_confidence",
    "match_method",
    "stance_method",
    "stance_model",
    "stance_label",
    "stance_intensity",
    "stance_score",
    "abs_stance_score",
    "stance_score_method",
    "model_stance_score_raw",
    "stance_confidence",
    "confidence_rank",
    "target_relevance",
    "target_relevance_rank",
    "ocr_quality_flag",
]


def top_stance_contexts(
    mentions: DataFrame,
    documents: DataFrame,
    dates: DataFrame,
    contexts: DataFrame,
    categories: DataFrame,
    audit: DataFrame,
) -> DataFrame:
    """Evidence passages with their ranks within figure and period. No cut is made:
    consumers filter on a rank. Positive and negative ranks count all passages of
    the group and are shown only for passages of that label."""
    # Documents come first, as they meet the mentions where both lie by document: as a list, since a passage is
    # ranked once, however often its document is listed. Audit ids are packed until the end.
    described = F.struct(*DOCUMENT_ATTRIBUTES, "conflicts_with_metadata_year")
    listed = documents.groupBy("document_id").agg(F.collect_list(described).alias("documents"))
    audit_id = "stance_audit_id", packed_digest(F.col("stance_audit_id"))
    audit = audit.withColumn(*audit_id)
    star = join_star_left(
        mentions.drop(*DATE_COLUMNS).withColumn(*audit_id),
        (
            categories.select(
                "stance_category_id",
                "stance_label",
                "stance_intensity",
                "stance_confidence",
                "target_relevance",
                "stance_score_method",
            ),
            "stance_category_id",
        ),
        (dates.select("date_key", "period_label", *DATE_COLUMNS), "date_key"),
        (listed, "document_id"),
        (
            audit.select(
                "stance_audit_id",
                "mention_id",
                "stance_method",
                "stance_model",
                "model_stance_score_raw",
                (F.length(F.trim("evidence_text")) > 0).alias("has_evidence"),
            ),
            ["stance_audit_id", "mention_id"],
        ),
    )
    confident = F.col("stance_confidence").isin("medium", "high")
    relevant = F.col("target_relevance").isin("direct", "indirect")
    evidence = star.where(
        confident & relevant & F.col("has_evidence")
    ).drop("has_evidence").withColumns(
        {
            "abs_stance_score": F.abs("stance_score"),
            "confidence_rank": vocabulary_rank(F.col("stance_confidence"), "high", "medium"),
            "target_relevance_rank": vocabulary_rank(
                F.col("target_relevance"), "direct", "indirect"
            ),
        }
    )
    quality = [("confidence_rank", "desc"), ("target_relevance_rank", "desc")]
    # Counted and placed: the joins run once.
    evidence = materialize(evidence.select(*EVIDENCE_COLUMNS))
    ranked = ranked_in_groups(
        evidence,
        group=["figure_id", "publication_year", "publication_month"],
        tie_order=["document_id", "mention_id"],
        rankings={
            "absolute_stance_rank_by_figure_period": [("abs_stance_score", "desc"), *quality],
            "positive_rank_by_figure_period": [("stance_score", "desc"), *quality],
            "negative_rank_by_figure_period": [("stance_score", "asc"), *quality],
        },
        sample_from=mentions,
    )
    # Texts join the ranked rows, not the rows being ranked.
    rest = [c for c in ranked.columns if c != "documents"]
    attached = join_star_left(
        ranked.select(*rest, F.inline_outer("documents")),
        (
            contexts.select(
                "mention_id",
                "context_window",
                "context_word_count",
                "context_start_char",
                "context_end_char",
            ),
            "mention_id",
        ),
        (
            audit.select(
                "stance_audit_id", "mention_id", "evidence_text", "evidence_translation_en", "explanation"
            ),
            ["stance_audit_id", "mention_id"],
        ),
    )
    label = F.col("stance_label")
    return attached.withColumns(
        {
            "stance_audit_id": unpacked_digest(F.col("stance_audit_id")),
            "positive_rank_by_figure_period": F.when(
                label == "positive", F.col("positive_rank_by_figure_period")
            ),
            "negative_rank_by_figure_period": F.when(
                label == "negative", F.col("negative_rank_by_figure_period")
            ),
            "is_analysis_ready": F.col("publication_year").isNotNull()
            & ~F.coalesce("conflicts_with_metadata_year", F.lit(False)),
        }
    ).select(
        "stance_audit_id",
        "mention_id",
        "document_id",
        *FIGURE,
        *DOCUMENT_ATTRIBUTES,
        "period_label",
        *DATE_COLUMNS,
        "conflicts_with_metadata_year",
        "matched_variant",
        "variant_type",
        "match_confidence",
        "match_method",
        "stance_method",
        "stance_model",
        "stance_label",
        "stance_intensity",
        "stance_score",
        "abs_stance_score",
        "stance_score_method",
        "model_stance_score_raw",
        "stance_confidence",
        "target_relevance",
        "evidence_text",
        "evidence_translation_en",
        "explanation",
        "context_window",
        "context_word_count",
        "context_start_char",
        "context_end_char",
        "ocr_quality_flag",
        "absolute_stance_rank_by_figure_period",
        "positive_rank_by_figure_period",
        "negative_rank_by_figure_period",
        "is_analysis_ready",
    )
