"""Dictionary mentions with character offsets and their word-window contexts.

A document never leaves its row while it is searched: the lexicon is a trie of words that
every task knows, and a text is walked through once, whatever the number of variants. The
only thing exploded is the finished list of mentions, so neither texts nor words are
shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.functions.common import hashed_key
from rostra.operators.contexts import context_windows
from rostra.operators.phrases import Phrases
from rostra.sources.shipping import ship

MATCH_METHOD = "dictionary_regex"

# Bytes of variants that a task knows at once. A larger lexicon is cut into slices of that
# size, and each has its own walk.
SLICE_BYTES = 64_000_000
# Bytes that a variant takes besides its text, about.
_VARIANT_BYTES = 500

# Letters that count as equal when case is ignored although lower
# casing keeps them apart (long s, dotless i, micro sign, final sigma, dotted long s).
CASE_TWINS = {"ſ": "s", "ı": "i", "µ": "μ", "ς": "σ", "ẛ": "ṡ"}

# Attributes of a variant that its mentions carry.
_ATTRIBUTES = ["figure_id", "variant_id", "matched_variant", "variant_normalized"]
_MENTION = pa.struct([
    ("match_start_char", pa.int32()), ("match_end_char", pa.int32()), *[(name, pa.string()) for name in _ATTRIBUTES],
])
_MENTIONS = (
    "array<struct<match_start_char:int,match_end_char:int,figure_id:string,"
    "variant_id:string,matched_variant:string,variant_normalized:string>>"
)


def fold_case_twins(text: Column) -> Column:
    """One-to-one replacement, so offsets keep their meaning."""
    present = F.lit(False)
    for letter in CASE_TWINS:
        present = present | F.contains(text, F.lit(letter))
    folded = F.translate(text, "".join(CASE_TWINS), "".join(CASE_TWINS.values()))
    return F.when(present, folded).otherwise(text)


@dataclass
class Lexicon:
    """A slice of the variants: their trie, and the attributes of each."""

    phrases: Phrases
    attributes: dict[str, pa.Array]

    def mentions(self, texts: pa.Array) -> pa.Array:
        """Mentions of every text, by start, end, figure and variant."""
        starts, ends, numbers, offsets = [], [], [], [0]
        for text in texts.to_pylist():
            for start, end, number in self.phrases.find(text or ""):
                starts.append(start)
                ends.append(end)
                numbers.append(number)
            offsets.append(len(starts))
        taken = pa.array(numbers, pa.int64())
        columns = [pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
        columns += [self.attributes[name].take(taken) for name in _ATTRIBUTES]
        found = pa.StructArray.from_arrays(columns, fields=list(_MENTION))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found)


def lexicon_slices(variants: DataFrame, slice_bytes: int = SLICE_BYTES) -> Iterator[Lexicon]:
    """The variants as tries of at most about ``slice_bytes``.

    A variant is in one slice, by a hash of its key, so that no slice but the one at hand
    is on the driver. Variants without a normal form match nothing.
    """
    needle = fold_case_twins(F.lower("variant_normalized"))
    rows = variants.where(F.col("variant_normalized") != "").select(
        "figure_id", "variant_id", F.col("variant").alias("matched_variant"), "variant_normalized", needle.alias("needle")
    )
    size = rows.agg(F.sum(F.octet_length("needle") + F.lit(_VARIANT_BYTES))).first()[0] or 0
    count = max(1, -(-size // slice_bytes))
    number = F.pmod(F.xxhash64("figure_id", "variant_id", "needle"), F.lit(count))
    for i in range(count):
        found = rows.where(number == i).toArrow().combine_chunks().sort_by([("figure_id", "ascending"), ("variant_id", "ascending")])
        attributes = {name: found[name].combine_chunks() for name in _ATTRIBUTES}
        yield Lexicon(Phrases(found["needle"].to_pylist()), attributes)


def mentions_in_text(texts: DataFrame, lexicon: Lexicon) -> Column:
    """Array of mentions of ``clean_text_lower``, which must be lower-cased and single-spaced.

    Sorted by (start, end, figure, variant). Overlapping mentions of different variants
    are all kept.
    """
    ship(texts.sparkSession)
    # No larger than a slice.
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield shared.value.mentions(texts)

    return F.arrow_udf(search, _MENTIONS)(fold_case_twins(F.coalesce("clean_text_lower", F.lit(""))))


def find_mentions(
    texts: DataFrame,
    variants: DataFrame,
    contexts: tuple[int, int] | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per mention of a lexicon variant in ``texts``.

    ``texts`` needs ``document_id``, ``clean_text_lower`` and, for contexts,
    ``clean_text``; ``variants`` is the variant dimension. With ``contexts=(before,
    after)`` the context columns come from the same pass over the text. A lexicon of
    several slices takes a pass for each.
    """
    return reduce(
        DataFrame.unionByName,
        [_mentions_of(texts, lexicon, contexts) for lexicon in lexicon_slices(variants, slice_bytes)],
    )


def _mentions_of(texts: DataFrame, lexicon: Lexicon, contexts: tuple[int, int] | None) -> DataFrame:
    mentions = mentions_in_text(texts, lexicon)
    found = texts.withColumn("mentions", mentions)
    # Outer explode plus a filter: an inner explode makes the optimizer add a size
    # check on the array, which would run the whole search a second time.
    if contexts is None:
        rows = found.select("document_id", F.explode_outer("mentions").alias("mention")).where(
            F.col("mention").isNotNull()
        )
        extra = []
    else:
        before, after = contexts
        spans = F.transform(
            "mentions",
            lambda m: F.struct(m["match_start_char"].alias("start"), m["match_end_char"].alias("end")),
        )
        cut = context_windows(F.col("clean_text"), spans, before, after)
        hits = F.when(
            F.size("mentions") > 0,
            F.zip_with("mentions", cut, lambda m, c: F.struct(m.alias("mention"), c.alias("context"))),
        )
        rows = (
            found.select("document_id", F.explode_outer(hits).alias("hit"))
            .where(F.col("hit").isNotNull())
            .select("document_id", "hit.mention", "hit.context")
        )
        extra = [
            F.lit(before).alias("words_before_requested"),
            F.lit(after).alias("words_after_requested"),
            "context.*",
        ]
    mention_id = hashed_key(
        F.col("document_id"),
        F.col("mention.figure_id"),
        F.col("mention.variant_id"),
        F.col("mention.match_start_char").cast("string"),
        F.col("mention.match_end_char").cast("string"),
    )
    method = F.lit(MATCH_METHOD).alias("match_method")
    return rows.select(mention_id.alias("mention_id"), "document_id", "mention.*", method, *extra)
