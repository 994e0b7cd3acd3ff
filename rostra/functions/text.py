"""Text cleaning, counting and quality flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators: the same set splits words
# when contexts are cut, so offsets and word positions always agree.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"

# Byte sequences left behind by doubly encoded UTF-8.
ENCODING_ARTIFACTS = r"Ãƒ|Ã‚|Ã¢â‚¬|ï¿½"

# Fixed value: texts below this many words are "very short".
SHORT_TEXT_WORDS = 100


def collapse_whitespace(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, WHITESPACE, " "))


def count_spaces(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit(" "), F.lit("")))


def word_count(clean_text: Column) -> Column:
    """Words of a collapsed text, counted without materialising them."""
    return F.when(clean_text == "", 0).otherwise(count_spaces(clean_text) + 1)


def has_encoding_artifacts(raw_text: Column) -> Column:
    return raw_text.rlike(ENCODING_ARTIFACTS)


def quality_flag(characters: Column, words: Column, artifacts: Column) -> Column:
    return (
        F.when(characters == 0, "empty_text")
        .when(words < SHORT_TEXT_WORDS, "very_short_text")
        .when(artifacts, "possible_encoding_artifacts")
        .otherwise("usable")
    )


def normalize_variant(value: Column) -> Column:
    return collapse_whitespace(F.lower(value))
