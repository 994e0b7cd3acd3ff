"""Publication dates from free text, as native SQL expressions.

Understands ISO dates, French day/month/year dates with old spellings, and
French Republican dates, which are converted to Gregorian ones.

The expressions are assembled as SQL text and parsed once; built call by call they
would need thousands of round trips to the JVM. ``text`` arguments are therefore
column names or SQL expressions.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostra.functions.text import WHITESPACE

# Month spellings, matched after lower-casing and accent removal.
FRENCH_MONTHS = {
    "janvier": 1, "janv": 1,
    "fevrier": 2, "fevr": 2, "fev": 2,
    "mars": 3,
    "avril": 4, "avr": 4,
    "mai": 5,
    "juin": 6,
    "juillet": 7, "juil": 7,
    "aout": 8, "aoust": 8,
    "septembre": 9, "sept": 9, "7bre": 9,
    "octobre": 10, "oct": 10, "8bre": 10,
    "novembre": 11, "nov": 11, "9bre": 11,
    "decembre": 12, "dec": 12, "10bre": 12, "xbre": 12,
}
REPUBLICAN_MONTHS = {
    "vendemiaire": 1, "vend": 1,
    "brumaire": 2, "brum": 2,
    "frimaire": 3, "frim": 3,
    "nivose": 4, "niv": 4,
    "pluviose": 5, "pluv": 5,
    "ventose": 6, "vent": 6,
    "germinal": 7, "germ": 7,
    "floreal": 8, "flor": 8,
    "prairial": 9, "prair": 9,
    "messidor": 10, "mess": 10,
    "thermidor": 11, "therm": 11,
    "fructidor": 12, "fruct": 12,
}

# Gregorian date of 1 Vendemiaire in each year the calendar was in use.
REPUBLICAN_YEAR_STARTS = {
    1: "1792-09-22", 2: "1793-09-22", 3: "1794-09-22", 4: "1795-09-23",
    5: "1796-09-22", 6: "1797-09-22", 7: "1798-09-22", 8: "1799-09-23",
    9: "1800-09-23", 10: "1801-09-23", 11: "1802-09-23", 12: "1803-09-24",
    13: "1804-09-23", 14: "1805-09-23",
}

# Numerals, notes and vocabulary of a parsed date. The note of a conversion
# is worded as existing tables have it; the conversion here is this module's own.
ROMAN_NUMERALS = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
NOTE_BAD_MONTH = "Invalid Gregorian month detected; preserved year only."
NOTE_BAD_DAY = "Invalid Gregorian day/month detected; preserved month precision."
NOTE_CONVERTED = "Converted from French Republican calendar using convertdate."
NOTE_MONTH_ONLY = (
    "French Republican month detected, but no day was available for exact conversion."
)
NOTE_MORE_PRECISE = "More precise date matched metadata year."

# How useful a precision is for dating, and which source is trusted more.
PRECISION_RANKS = {"day": 3, "month": 2, "year": 1, "revolutionary_month": 1}
SOURCE_RANKS = {"metadata_date": 3, "title": 2, "ocr_front_matter": 1}

YEAR = r"(?:1[5-9][0-9]{2}|20[0-9]{2})"
DAY = r"[0-9]{1,2}(?:er)?"
NUMERAL = r"(?:[ivxlcdm]+|[0-9]+)"
FRENCH = "(?:" + "|".join(FRENCH_MONTHS) + ")"
REPUBLICAN = "(?:" + "|".join(REPUBLICAN_MONTHS) + ")"

FIELDS = {
    "publication_year": "int",
    "publication_month": "int",
    "publication_day": "int",
    "publication_date": "date",
    "date_precision": "string",
    "date_source": "string",
    "date_calendar": "string",
    "date_parse_confidence": "string",
    "date_parse_notes": "string",
}


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and calls it ``name`` inside ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _map(table: dict) -> str:
    return "map(" + ", ".join(f"{key!r}, {value!r}" for key, value in table.items()) + ")"


def _lookup(table: dict, key: str) -> str:
    return f"try_element_at({_map(table)}, {key})"


def _folding_table() -> tuple[str, str]:
    """One-to-one compatibility folding of Latin letters, digits and spaces.

    Derived from the Unicode database instead of being spelled out.
    """
    ranges = [(0x80, 0x250), (0x1E00, 0x1F00), (0x2000, 0x2190), (0xFF01, 0xFF5F)]
    source, target = "", ""
    for low, high in ranges:
        for letter in map(chr, range(low, high)):
            base = [
                part
                for part in unicodedata.normalize("NFKD", letter)
                if not unicodedata.combining(part)
            ]
            if len(base) == 1 and base[0] != letter and base[0] not in "'\"\\":
                source, target = source + letter, target + base[0]
    return source, target


def _unligatured(text: str) -> str:
    for letter in map(chr, range(0xFB00, 0xFB07)):
        text = f"replace({text}, '{letter}', '{unicodedata.normalize('NFKD', letter)}')"
    return text


def normalized_text(text: str) -> str:
    """SQL: lower case, no accents, punctuation to spaces, single-spaced; '' for NULL."""
    source, target = _folding_table()
    unaccented = (
        f"regexp_replace(translate(CASE WHEN t RLIKE '[ﬀ-ﬆ]' THEN {_unligatured('t')} "
        rf"ELSE t END, '{source}', '{target}'), r'\p{{Mn}}+', '')"
    )
    spaced = rf"regexp_replace({unaccented}, r'(?:[,.\x27…]|{WHITESPACE})+', ' ')"
    return _let("t", f"lower(coalesce({text}, ''))", f"trim({spaced})")


def date_struct(**values: str) -> str:
    """SQL struct of the date fields; what is not given is unknown."""
    defaults = {
        "date_precision": "'unknown'",
        "date_source": "'none'",
        "date_calendar": "'unknown'",
        "date_parse_confidence": "'low'",
    }
    fields = {name: values.get(name, defaults.get(name, "NULL")) for name in FIELDS}
    return "named_struct(" + ", ".join(
        f"'{name}', cast({value} AS {FIELDS[name]})" for name, value in fields.items()
    ) + ")"


def roman_value(numeral: str) -> str:
    """Read from the right: a digit smaller than the last one that was added is taken off."""
    digits = f"transform(regexp_extract_all({numeral}, '(.)', 1), c -> {_lookup(ROMAN_NUMERALS, 'c')})"
    step = (
        "(s, x) -> CASE WHEN x < s.added THEN named_struct('total', s.total - x, 'added', s.added) "
        "ELSE named_struct('total', s.total + x, 'added', x) END"
    )
    start = "named_struct('total', 0, 'added', 0)"
    return f"nullif(aggregate(reverse({digits}), {start}, {step}, s -> s.total), 0)"


def republican_year(numeral: str) -> str:
    return (
        f"CASE WHEN {numeral} RLIKE '^[0-9]+$' THEN try_cast({numeral} AS int) "
        f"ELSE {roman_value(numeral)} END"
    )


def republican_to_gregorian(year: str, month: str, day: str) -> str:
    """Gregorian date. Months have 30 days each.

    Years I-XIV began as they did. For those after the calendar was given up, leap years
    are counted as proposed for it: XX and every fourth from there, by Gregorian centuries.
    """
    known = f"cast({_lookup(REPUBLICAN_YEAR_STARTS, 'a')} AS date)"
    leaps = "floor((a - 1) / 4) - floor((a - 1) / 100) + floor((a - 1) / 400)"
    later = f"date_add(date'1792-09-22', cast(365 * (a - 1) + {leaps} AS int))"
    # Beyond 9999 a year is no date; 0 is no year.
    start = f"CASE WHEN a BETWEEN 15 AND 8000 THEN {later} ELSE {known} END"
    return _let("a", year, f"date_add({start}, ({month} - 1) * 30 + {day} - 1)")


def _gregorian(year: str, month: str, day: str, found: dict[str, str]) -> str:
    """Keep as much of a Gregorian date as is valid; NULL when the day cannot be a day."""
    full = "try_cast(format_string('%04d-%02d-%02d', g.y, g.m, g.d) AS date)"
    result = date_struct(
        publication_year="g.y",
        publication_month="CASE WHEN g.m BETWEEN 1 AND 12 THEN g.m END",
        publication_day="CASE WHEN f IS NOT NULL THEN g.d END",
        publication_date="f",
        date_precision="CASE WHEN f IS NOT NULL THEN 'day' WHEN g.m BETWEEN 1 AND 12 THEN 'month' "
        "ELSE 'year' END",
        date_calendar="'gregorian'",
        date_parse_notes=f"CASE WHEN g.m NOT BETWEEN 1 AND 12 THEN '{NOTE_BAD_MONTH}' "
        f"WHEN f IS NULL THEN '{NOTE_BAD_DAY}' END",
        **found,
    )
    parts = f"named_struct('y', {year}, 'm', {month}, 'd', {day})"
    return _let("g", parts, f"CASE WHEN g.d BETWEEN 1 AND 31 THEN {_let('f', full, result)} END")


def _rule(pattern: str, separator: str, result: str) -> str:
    """Result built from the words ``w`` of the first match, NULL without a match."""
    words = rf"split(regexp_extract(n, r'(?U)\b{pattern}\b', 0), '{separator}')"
    return _let("w", words, f"CASE WHEN w[0] <> '' THEN {result} END")


def _number(position: int) -> str:
    return f"try_cast(w[{position}] AS int)"


_DAY_NUMBER = "try_cast(replace(w[0], 'er', '') AS int)"


def date_from_text_sql(text: str, source: str, confidence: str) -> str:
    """SQL struct with the date found in one text; the first rule that yields one wins.

    ``coalesce`` stops at the first hit, so later patterns are not even tried.
    """
    found = {"date_source": f"'{source}'", "date_parse_confidence": f"'{confidence}'"}
    republican_day = republican_to_gregorian(
        republican_year("w[3]"), _lookup(REPUBLICAN_MONTHS, "w[1]"), _DAY_NUMBER
    )
    converted = date_struct(
        publication_year="year(r)",
        publication_month="month(r)",
        publication_day="day(r)",
        publication_date="r",
        date_precision="'day'",
        date_calendar="'french_republican'",
        date_parse_notes=f"'{NOTE_CONVERTED}'",
        **found,
    )
    month = date_struct(
        publication_year=_number(1),
        publication_month=_lookup(FRENCH_MONTHS, "w[0]"),
        date_precision="'month'",
        date_calendar="'gregorian'",
        **found,
    )
    republican_month = date_struct(
        publication_month=_lookup(REPUBLICAN_MONTHS, "w[0]"),
        date_precision="'revolutionary_month'",
        date_source=f"'{source}'",
        date_calendar="'french_republican'",
        date_parse_notes=f"'{NOTE_MONTH_ONLY}'",
    )
    year = date_struct(
        publication_year=_number(0), date_precision="'year'", date_calendar="'gregorian'", **found
    )
    french_day = _gregorian(_number(2), _lookup(FRENCH_MONTHS, "w[1]"), _DAY_NUMBER, found)
    rules = [
        _rule(
            rf"{YEAR}[-/][0-9]{{1,2}}[-/][0-9]{{1,2}}",
            "[-/]",
            _gregorian(_number(0), _number(1), _number(2), found),
        ),
        _rule(
            f"{DAY} {REPUBLICAN} an {NUMERAL}",
            " ",
            f"CASE WHEN {_DAY_NUMBER} BETWEEN 1 AND 30 THEN "
            + _let("r", republican_day, f"CASE WHEN r IS NOT NULL THEN {converted} END")
            + " END",
        ),
        _rule(f"{DAY} {FRENCH} {YEAR}", " ", french_day),
        _rule(f"{FRENCH} {YEAR}", " ", month),
        _rule(f"{REPUBLICAN} an {NUMERAL}", " ", republican_month),
        _rule(YEAR, " ", year),
    ]
    first = _let("n", normalized_text(text), f"CASE WHEN n <> '' THEN coalesce({', '.join(rules)}) END")
    return f"coalesce({first}, {date_struct()})"


def date_from_text(text: str, source: str, confidence: str) -> Column:
    return F.expr(date_from_text_sql(text, source, confidence))


def best_publication_date(date_raw: str, title: str, front_matter: str) -> Column:
    """Most precise date of the three sources that does not contradict the metadata year."""
    sources = [
        date_from_text_sql(date_raw, "metadata_date", "high"),
        date_from_text_sql(title, "title", "medium"),
        date_from_text_sql(front_matter, "ocr_front_matter", "low"),
    ]
    agreeing = (
        "filter(s, x -> x.date_precision <> 'unknown' "
        "AND NOT coalesce(x.publication_year <> s[0].publication_year, false))"
    )
    ranked = (
        f"transform({agreeing}, x -> named_struct("
        f"'precision', {_lookup(PRECISION_RANKS, 'x.date_precision')}, "
        f"'source', {_lookup(SOURCE_RANKS, 'x.date_source')}, 'date', x))"
    )
    confirmed = "b.date_source <> 'metadata_date' AND b.publication_year = s[0].publication_year"
    kept = {name: f"b.{name}" for name in FIELDS}
    kept["date_parse_notes"] = (
        f"CASE WHEN {confirmed} THEN concat_ws(' ', b.date_parse_notes, '{NOTE_MORE_PRECISE}') "
        "ELSE b.date_parse_notes END"
    )
    # array_max of an empty array is NULL, which falls back to "unknown".
    best = _let("b", f"array_max({ranked}).date", f"CASE WHEN b IS NOT NULL THEN {date_struct(**kept)} END")
    chosen = _let("s", f"array({', '.join(sources)})", best)
    return F.expr(f"coalesce({chosen}, {date_struct()})")


def year_in_text(text: Column) -> Column:
    """First four-digit year 1500-2099, without word boundaries; NULL if there is none."""
    return F.regexp_extract(text, YEAR, 0).try_cast("int")
