"""Small helpers shared by the column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    Regular expressions and splits are costly and the optimizer only removes
    duplicates inside generated code, so the value is bound as a lambda variable.
    """
    return F.transform(F.array(value), body).getItem(0)


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def hashed_key(*parts: Column) -> Column:
    """SHA-256 of the ``|``-joined parts. NULL parts are skipped, so coalesce first
    wherever a NULL has to stay distinguishable."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def name_key(name: Column) -> Column:
    """Case- and margin-insensitive identifier of a creator or subject name."""
    return F.sha2(F.lower(F.trim(name)), 256)


def date_key(
    year: Column, month: Column, day: Column, precision: Column, calendar: Column
) -> Column:
    known = [
        F.coalesce(part.cast("string"), F.lit("unknown"))
        for part in (year, month, day, precision, calendar)
    ]
    return hashed_key(*known)


def period_label(year: Column, month: Column) -> Column:
    """``Unknown``, ``YYYY`` or ``YYYY-MM``."""
    year_text = year.cast("string")
    month_text = F.lpad(month.cast("string"), 2, "0")
    return F.coalesce(
        F.concat(year_text, F.lit("-"), month_text), year_text, F.lit("Unknown")
    )


def vocabulary_rank(value: Column, *descending: str) -> Column:
    """Rank of a closed-vocabulary value: first listed is highest, others are 0."""
    rank = F.lit(0)
    for position, word in enumerate(reversed(descending), start=1):
        rank = F.when(value == word, position).otherwise(rank)
    return rank


def beginning(text: Column, characters: int | None) -> Column:
    """The first characters of a text; all of it without a number."""
    return text if characters is None else F.substring(text, 1, characters)


def packed_digest(text: Column) -> Column:
    """A hexadecimal digest of 32 bytes in 33, and any other text as it is: for ids on their way through a shuffle,
    which does not halve their digits. Different texts stay different, and NULL stays NULL."""
    raw = F.unhex(text)
    plain = F.concat(F.lit(b"\x00"), text.cast("binary"))
    return F.when((F.length(text) == 64) & (F.lower(F.hex(raw)) == text), F.concat(F.lit(b"\x01"), raw)).otherwise(plain)


def unpacked_digest(packed: Column) -> Column:
    """The text of which ``packed_digest`` was made."""
    rest = F.substring(packed, F.lit(2), F.length(packed) - 1)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
