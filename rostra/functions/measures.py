"""Aggregate building blocks of the gold tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_when(condition: Column) -> Column:
    """Rows where the condition is true; NULL counts as false."""
    return F.count_if(condition)


def safe_ratio(numerator: str, denominator: str) -> Column:
    """Share as DOUBLE, NULL when the denominator is zero or unknown."""
    bottom = F.col(denominator).cast("double")
    return F.when(bottom > 0, F.col(numerator).cast("double") / bottom)


def is_included(confidence: Column, score: Column) -> Column:
    """Stance rows that enter the averages. Three-valued: an unscored row is NULL."""
    return confidence.isin("medium", "high") & score.isNotNull()


# Scores lie between -1 and 1. Summed as decimals they add up to the same value in
# whatever order the rows arrive, so a balanced document is exactly zero.
EXACT_SCORE = "decimal(8,6)"


def exact_sum(score: Column) -> Column:
    return F.sum(score.cast(EXACT_SCORE))


def mean(total: Column, count: Column) -> Column:
    """Total over count as DOUBLE; NULL for a count of zero."""
    return total.cast("double") / F.nullif(count, F.lit(0)).cast("double")


def document_label(average_score: Column, included: Column) -> Column:
    return (
        F.when(average_score > 0, "positive")
        .when(average_score < 0, "negative")
        .when(included > 0, "neutral")
        .otherwise("not_included")
    )
