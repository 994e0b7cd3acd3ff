"""Word-window contexts for mentions given as character offsets in any text."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.sources.shipping import ship

# Default window size in words.
WORDS_BEFORE = 75
WORDS_AFTER = 75

# Python's white space is Unicode's and the four ASCII separators, as in ``functions.text``.
_WORD = re.compile(r"\S+")
# Characters of a text whose mentions are cut in one row; a longer text meets its
# mentions in several.
_STRETCH = 1 << 20
# Characters of windows that a task holds before it hands them over.
_HELD = 1 << 24

_COUNTS = ["words_before_actual", "words_after_actual", "context_word_count", "context_start_char", "context_end_char"]
_WINDOW = pa.struct([*[(name, pa.int32()) for name in _COUNTS], ("context_window", pa.string())])
_WINDOWS = f"array<struct<{','.join(f'{name}:int' for name in _COUNTS)},context_window:string>>"
_EMPTY = (0, 0, 0, 0, 0, "")


def _windows_of(text: str, spans: list[tuple[int | None, int | None]], before: int, after: int) -> Iterator[tuple]:
    words = [found.span() for found in _WORD.finditer(text)]
    starts, ends = [start for start, _ in words], [end for _, end in words]
    for start, end in spans:
        first = 0 if start is None else bisect_right(ends, start)
        last = -1 if end is None else bisect_right(starts, end - 1) - 1
        if first > last:
            yield _EMPTY
            continue
        left, right = max(first - before, 0), min(last + after, len(words) - 1)
        a, b = starts[left], ends[right]
        yield first - left, right - last, right - left + 1, a, b, text[a:b]


def _as_lists(windows: list[tuple], offsets: list[int | None]) -> pa.Array:
    columns = list(zip(*windows)) or [()] * len(_WINDOW)
    values = [pa.array(column, field.type) for column, field in zip(columns, _WINDOW)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(values, fields=list(_WINDOW)))


def _cut(texts: pa.Array, spans: pa.Array, before: int, after: int) -> Iterator[pa.Array]:
    """Windows of every text, in arrays of about ``_HELD`` characters."""
    windows: list[tuple] = []
    offsets: list[int | None] = []
    held = 0
    for text, wanted in zip(texts, spans):
        if held >= _HELD:
            yield _as_lists(windows, [*offsets, len(windows)])
            windows, offsets, held = [], [], 0
        offsets.append(len(windows) if wanted.is_valid else None)
        if not wanted.is_valid or not len(wanted):
            continue
        found = wanted.values
        pairs = list(zip(found.field("start").to_pylist(), found.field("end").to_pylist()))
        for window in _windows_of(text.as_py() or "", pairs, before, after):
            windows.append(window)
            held += len(window[-1])
    if offsets:
        yield _as_lists(windows, [*offsets, len(windows)])


def context_windows(
    text: Column, spans: Column, before: int = WORDS_BEFORE, after: int = WORDS_AFTER
) -> Column:
    """One struct per span (``start``, ``end``): the substring around it and its word counts.

    Words are runs of non-space characters; those that overlap the span are its own.
    Without any such word the struct is an empty string and zeros. The words of the text
    are located once, whatever the number of spans, and no word or gap is too long.
    """
    ship(SparkSession.active())

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, wanted in batches:
            yield from _cut(texts, wanted, before, after)

    return F.arrow_udf(cut, _WINDOWS)(F.make_valid_utf8(F.coalesce(text, F.lit(""))), spans)


def context_window(
    text: Column, start: Column, end: Column, before: int = WORDS_BEFORE, after: int = WORDS_AFTER
) -> Column:
    """The context of one span, see ``context_windows``."""
    span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
    return F.element_at(context_windows(text, F.array(span), before, after), 1)


def mention_contexts(
    mentions: DataFrame,
    texts: DataFrame,
    before: int = WORDS_BEFORE,
    after: int = WORDS_AFTER,
) -> DataFrame:
    """Contexts for an existing mention table.

    ``find_mentions(..., contexts=...)`` cuts them while the text is at hand and is the
    cheaper way; this join is for mentions that came from elsewhere. The mentions of a
    document, or of a million characters of a long one, meet its text in one row.
    """
    grouped = (
        mentions.select("mention_id", "document_id", "match_start_char", "match_end_char")
        .groupBy("document_id", F.floor(F.col("match_start_char") / _STRETCH).alias("_stretch"))
        .agg(
            F.collect_list(
                F.struct(
                    "mention_id", F.col("match_start_char").alias("start"), F.col("match_end_char").alias("end")
                )
            ).alias("_spans")
        )
    )
    cut = context_windows(F.col("clean_text"), F.col("_spans"), before, after)
    return (
        grouped.join(texts.select("document_id", "clean_text", "file_path"), "document_id", "left")
        # An inner explode makes the optimizer add a size check, which would run the whole cut a second time.
        .select("document_id", "file_path", F.explode_outer(F.arrays_zip("_spans", cut.alias("context"))).alias("hit"))
        .select(
            "hit._spans.mention_id",
            "document_id",
            F.lit(before).alias("words_before_requested"),
            F.lit(after).alias("words_after_requested"),
            "hit.context.*",
            "file_path",
        )
    )
