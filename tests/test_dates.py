"""Golden dates: raw date, title, front matter -> parsed fields."""

import datetime as dt

import pytest

from rostra.functions.dates import best_publication_date, date_from_text

Y, M, D = "publication_year", "publication_month", "publication_day"
CASES = [
    ("1789", None, None, (1789, None, None, "year", "metadata_date", "gregorian", "high")),
    ("août 1792", None, None, (1792, 8, None, "month", "metadata_date", "gregorian", "high")),
    ("1792-08-10", None, None, (1792, 8, 10, "day", "metadata_date", "gregorian", "high")),
    (None, "Discours prononcé le 14 juillet 1789", None,
     (1789, 7, 14, "day", "title", "gregorian", "medium")),
    (None, "Rapport du 9 thermidor an II", None,
     (1794, 7, 27, "day", "title", "french_republican", "medium")),
    (None, "Rapport de thermidor an II", None,
     (None, 11, None, "revolutionary_month", "title", "french_republican", "low")),
    (None, "Sans date claire", None, (None, None, None, "unknown", "none", "unknown", "low")),
    (None, "Sans date claire", "Imprimé à Paris le 10 août 1792 avec permission.",
     (1792, 8, 10, "day", "ocr_front_matter", "gregorian", "low")),
    ("1789", None, "Fait à Paris le 9 thermidor an II.",
     (1789, None, None, "year", "metadata_date", "gregorian", "high")),
    (None, None, "Fait à Paris le 9 thermidor an II.",
     (1794, 7, 27, "day", "ocr_front_matter", "french_republican", "low")),
    ("1792", None, "Imprimé à Paris le 10 août 1792.",
     (1792, 8, 10, "day", "ocr_front_matter", "gregorian", "low")),
    ("1789", None, "Imprimé à Paris le 10 août 1792.",
     (1789, None, None, "year", "metadata_date", "gregorian", "high")),
    (None, "Lettre du 10 aoust 1792", None, (1792, 8, 10, "day", "title", "gregorian", "medium")),
    (None, "Adresse du 5 7bre 1791", None, (1791, 9, 5, "day", "title", "gregorian", "medium")),
    (None, "Rapport du 9 therm an II", None,
     (1794, 7, 27, "day", "title", "french_republican", "medium")),
    (None, "Adresse du 10 avru 1792", None,
     (1792, None, None, "year", "title", "gregorian", "medium")),
    (None, "Adresse du 31 novembre 1788", None,
     (1788, 11, None, "month", "title", "gregorian", "medium")),
    # Further cases: bad month, ligature, long numerals, the whole calendar.
    ("1788-13-02", None, None, (1788, None, None, "year", "metadata_date", "gregorian", "high")),
    (None, "11 ﬂoréal an xiv", None, (1806, 5, 1, "day", "title", "french_republican", "medium")),
    (None, "1er vendémiaire, an IIII", None,
     (1795, 9, 23, "day", "title", "french_republican", "medium")),
    (None, "30 fructidor an 11", None, (1803, 9, 17, "day", "title", "french_republican", "medium")),
    (None, "9 thermidor an 79", None, (1871, 7, 28, "day", "title", "french_republican", "medium")),
    (None, "thermidor de l'an II", None, (None, None, None, "unknown", "none", "unknown", "low")),
    ("", "  ", None, (None, None, None, "unknown", "none", "unknown", "low")),
]


def test_best_of_sources(spark):
    rows = [(i, *case[:3]) for i, case in enumerate(CASES)]
    frame = spark.createDataFrame(rows, "i int, raw string, title string, front string")
    found = frame.select("i", best_publication_date("raw", "title", "front").alias("d")).orderBy("i")
    for row, (*texts, expected) in zip(found.collect(), CASES):
        d = row.d
        got = (d[Y], d[M], d[D], d.date_precision, d.date_source, d.date_calendar,
               d.date_parse_confidence)
        assert got == expected, texts
        if d.date_precision == "day":
            assert d.publication_date == dt.date(*expected[:3])
        else:
            assert d.publication_date is None


def test_notes(spark):
    frame = spark.createDataFrame(
        [("1792", None, "le 10 août 1792"), ("1794", "9 thermidor an II", None)],
        "raw string, title string, front string",
    )
    notes = [
        r.d.date_parse_notes
        for r in frame.select(best_publication_date("raw", "title", "front").alias("d")).collect()
    ]
    assert notes[0] == "More precise date matched metadata year."
    assert notes[1].endswith("More precise date matched metadata year.")
    assert notes[1].startswith("Converted from French Republican calendar")


@pytest.mark.parametrize("text, expected", [
    ("9 thermidor an VIII", dt.date(1800, 7, 28)),
    ("9 thermidor an IIX", dt.date(1800, 7, 28)),
    ("9 thermidor an IIV", dt.date(1795, 7, 27)),
    ("9 thermidor an XIIX", None),
    ("1er vendémiaire an XV", dt.date(1806, 9, 23)),
    ("1er vendemiaire an XX", dt.date(1811, 9, 23)),
    ("1er vendemiaire an 21", dt.date(1812, 9, 23)),
])
def test_numerals_and_late_republican_years(spark, text, expected):
    """Numerals are read from the right: IIV is 5 - 2, IIX is 10 - 2."""
    frame = spark.createDataFrame([(text,)], "t string")
    found = frame.select(date_from_text("t", "title", "medium").alias("d")).first().d.publication_date
    if text.endswith("XIIX"):
        # 10 + 10 - 2
        expected = dt.date(1792, 9, 22) + dt.timedelta(days=365 * 17 + 17 // 4 + 10 * 30 + 8)
    assert found == expected
