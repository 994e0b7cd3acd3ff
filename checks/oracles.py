"""DuckDB SQL that states what each query must return."""

from __future__ import annotations

from checks.fixtures import FRENCH, date_key_sql, period_label_sql, with_tables
from rostra.functions.dates import (
    FRENCH_MONTHS,
    NOTE_BAD_DAY,
    NOTE_BAD_MONTH,
    NOTE_CONVERTED,
    NOTE_MONTH_ONLY,
    NOTE_MORE_PRECISE,
    REPUBLICAN_MONTHS,
    REPUBLICAN_YEAR_STARTS,
)

TABLES: dict[str, str] = {}
ORACLES: dict[str, str] = {}

DATE_FIELDS = (
    "publication_year, publication_month, publication_day, publication_date, date_precision, "
    "date_source, date_calendar, date_parse_confidence, date_parse_notes"
)
DATE_COLUMNS = (
    "publication_year, publication_month, publication_day, "
    "cast(publication_date AS varchar) AS publication_date, date_precision, date_calendar"
)


def clean(value: str) -> str:
    return f"nullif(trim(regexp_replace({value}, '\\s+', ' ', 'g')), '')"


def map_sql(table: dict) -> str:
    return "MAP {" + ", ".join(f"{k!r}: {v!r}" for k, v in table.items()) + "}"


# ---- dates from text ----

_YEAR = "1[5-9][0-9]{2}|20[0-9]{2}"
_FR, _REP = "|".join(FRENCH_MONTHS), "|".join(REPUBLICAN_MONTHS)
_ROMAN = {word: n for n, word in enumerate(
    "i ii iii iv v vi vii viii ix x xi xii xiii xiv".split(), start=1)}


def date_select(table: str, text: str, source: str, confidence: str) -> str:
    """One row per row of ``table``: document_id and the nine date fields of ``text``."""

    def packed(y="NULL", m="NULL", d="NULL", date="NULL", p="'unknown'", s=f"'{source}'",
               c="'gregorian'", conf=f"'{confidence}'", note="NULL"):
        return (
            f"struct_pack(publication_year := try_cast({y} AS int), publication_month := cast({m} AS int), "
            f"publication_day := cast({d} AS int), publication_date := cast({date} AS date), "
            f"date_precision := {p}, date_source := {s}, date_calendar := {c}, "
            f"date_parse_confidence := {conf}, date_parse_notes := cast({note} AS varchar))"
        )

    def gregorian(y, m, d):
        date = f"try_cast(printf('%04d-%02d-%02d', {y}, {m}, {d}) AS date)"
        return packed(
            y, f"CASE WHEN {m} BETWEEN 1 AND 12 THEN {m} END",
            f"CASE WHEN {date} IS NOT NULL THEN {d} END", date,
            f"CASE WHEN NOT ({m} BETWEEN 1 AND 12) THEN 'year' WHEN {date} IS NULL THEN 'month' "
            "ELSE 'day' END",
            note=f"CASE WHEN NOT ({m} BETWEEN 1 AND 12) THEN '{NOTE_BAD_MONTH}' "
            f"WHEN {date} IS NULL THEN '{NOTE_BAD_DAY}' END",
        )

    fr, rep = map_sql(FRENCH_MONTHS), map_sql(REPUBLICAN_MONTHS)
    starts, roman = map_sql(REPUBLICAN_YEAR_STARTS), map_sql(_ROMAN)
    return rf"""
    SELECT document_id, unnest(found) FROM (
      SELECT document_id, CASE
        WHEN iso.y <> '' AND try_cast(iso.d AS int) BETWEEN 1 AND 31
            THEN {gregorian("try_cast(iso.y AS int)", "try_cast(iso.m AS int)", "try_cast(iso.d AS int)")}
        WHEN rd.m <> '' AND try_cast(rd.d AS int) BETWEEN 1 AND 30 AND converted IS NOT NULL
            THEN {packed("year(converted)", "month(converted)", "day(converted)", "converted",
                         "'day'", c="'french_republican'", note=f"'{NOTE_CONVERTED}'")}
        WHEN fd.m <> '' AND try_cast(fd.d AS int) BETWEEN 1 AND 31
            THEN {gregorian("try_cast(fd.y AS int)", f"{fr}[fd.m]", "try_cast(fd.d AS int)")}
        WHEN fm.m <> '' THEN {packed("fm.y", f"{fr}[fm.m]", p="'month'")}
        WHEN rm <> '' THEN {packed(m=f"{rep}[rm]", p="'revolutionary_month'",
            c="'french_republican'", conf="'low'", note=f"'{NOTE_MONTH_ONLY}'")}
        WHEN yo <> '' THEN {packed("yo", p="'year'")}
        ELSE {packed(s="'none'", c="'unknown'", conf="'low'")} END AS found
      FROM (SELECT *, cast({starts}[coalesce({roman}[rd.y], try_cast(rd.y AS int))] AS date)
            + cast(({rep}[rd.m] - 1) * 30 + try_cast(rd.d AS int) - 1 AS int) AS converted
        FROM (SELECT document_id,
            regexp_extract(n, '\b({_YEAR})[-/]([0-9]{{1,2}})[-/]([0-9]{{1,2}})\b', ['y', 'm', 'd']) AS iso,
            regexp_extract(n, '\b([0-9]{{1,2}})(?:er)?\s+({_REP})\s+an\s+([ivxlcdm]+|[0-9]+)\b', ['d', 'm', 'y']) AS rd,
            regexp_extract(n, '\b([0-9]{{1,2}})(?:er)?\s+({_FR})\s+({_YEAR})\b', ['d', 'm', 'y']) AS fd,
            regexp_extract(n, '\b({_FR})\s+({_YEAR})\b', ['m', 'y']) AS fm,
            regexp_extract(n, '\b({_REP})\s+an\s+([ivxlcdm]+|[0-9]+)\b', 1) AS rm,
            regexp_extract(n, '\b({_YEAR})\b', 1) AS yo
          FROM (SELECT document_id, trim(regexp_replace(regexp_replace(
              lower(strip_accents(coalesce({text}, ''))), '[,.'']', ' ', 'g'), '\s+', ' ', 'g')) AS n
            FROM {table}))))"""


def best_select(raw: str, title: str, front: str) -> str:
    """Best of three tables made by ``date_select``."""
    return f"""
    SELECT document_id, {DATE_FIELDS.replace("date_parse_notes", '''CASE
        WHEN date_source NOT IN ('metadata_date', 'none') AND publication_year = metadata_year
        THEN concat_ws(' ', date_parse_notes, ''' + f"'{NOTE_MORE_PRECISE}'" + ''')
        ELSE date_parse_notes END AS date_parse_notes''')}
    FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY
            CASE WHEN publication_year <> metadata_year THEN 0 ELSE CASE date_precision
                WHEN 'day' THEN 3 WHEN 'month' THEN 2 WHEN 'unknown' THEN 0 ELSE 1 END END DESC,
            rank DESC) AS place
        FROM (SELECT a.*, m.publication_year AS metadata_year FROM (
            SELECT *, 3 AS rank FROM {raw} UNION ALL SELECT *, 2 FROM {title}
            UNION ALL SELECT *, 1 FROM {front}
            UNION ALL SELECT document_id, NULL, NULL, NULL, NULL, 'unknown', 'none', 'unknown',
                'low', NULL, 9 FROM {raw}) a
          JOIN {raw} m ON a.document_id = m.document_id))
    WHERE place = 1"""


TABLES["o_d_raw"] = date_select("{d_texts}", "date_raw", "metadata_date", "high")
TABLES["o_d_title"] = date_select("{d_texts}", "title", "title", "medium")
TABLES["o_d_front"] = date_select("{d_texts}", "front_matter", "ocr_front_matter", "low")
_SHOWN = DATE_FIELDS.replace(
    "publication_date,", "cast(publication_date AS varchar) AS publication_date,"
)
ORACLES["date_from_text"] = f"SELECT document_id, {_SHOWN} FROM {{o_d_title}}"
TABLES["o_d_best"] = best_select("{o_d_raw}", "{o_d_title}", "{o_d_front}")
ORACLES["date_best_of_sources"] = f"SELECT document_id, {_SHOWN} FROM {{o_d_best}}"

# ---- metadata and the dimensional model ----


def tag(name: str) -> str:
    return clean(f"regexp_extract(x, '<{name}>(.*?)</{name}>', 1)")


def tags(name: str) -> str:
    values = (
        f"list_filter(list_transform(regexp_extract_all(x, '<{name}>(.*?)</{name}>', 1), "
        f"lambda v: {clean('v')}), lambda v: v IS NOT NULL)"
    )
    return f"list_filter({values}, lambda v, i: list_position({values}, v) = i)"


TABLES["o_meta"] = f"""
    SELECT document_id, file_path AS metadata_file_path, {tag("identifier")} AS metadata_document_id,
        {tag("title")} AS title, creators[1] AS creator, coalesce(creators[1], authors[1]) AS author,
        creators, authors, subjects, CASE WHEN len(subjects) > 0 THEN
            array_to_string(subjects, '; ') END AS subjects_raw,
        {tag("date")} AS publication_date_raw, {tag("language")} AS language,
        {tag("identifier")} AS internet_archive_id, {tag("identifier-access")} AS source_url,
        CASE WHEN bad THEN 'parse_error' ELSE 'success' END AS metadata_parse_status
    FROM (SELECT *, {tags("creator")} AS creators, {tags("author")} AS authors,
            {tags("subject")} AS subjects
        FROM (SELECT *, raw_metadata_xml = '' OR raw_metadata_xml NOT LIKE '%</title>%' AS bad,
            CASE WHEN raw_metadata_xml LIKE '%</title>%' THEN raw_metadata_xml ELSE '' END AS x
            FROM {{t_metadata}}))"""
ORACLES["metadata_parse"] = """
    SELECT document_id, metadata_file_path, metadata_document_id, title, creator, author,
        array_to_string(creators, '; ') AS creators, array_to_string(authors, '; ') AS metadata_authors,
        array_to_string(subjects, '; ') AS subjects, subjects_raw, publication_date_raw, language,
        internet_archive_id, source_url, metadata_parse_status
    FROM {o_meta}"""

TABLES["o_front"] = """
    SELECT document_id, m.title, m.publication_date_raw, substr(raw_text, 1, 2000) AS front,
        t.document_id IS NOT NULL AS has_ocr_text FROM {o_meta} m LEFT JOIN {t_ocr} t USING (document_id)"""
TABLES["o_t_raw"] = date_select("{o_front}", "publication_date_raw", "metadata_date", "high")
TABLES["o_t_title"] = date_select("{o_front}", "title", "title", "medium")
TABLES["o_t_front"] = date_select("{o_front}", "front", "ocr_front_matter", "low")
TABLES["o_t_best"] = best_select("{o_t_raw}", "{o_t_title}", "{o_t_front}")
TABLES["o_parsed"] = f"""
    SELECT m.*, f.front AS ocr_front_matter, f.has_ocr_text, b.* EXCLUDE (document_id),
        {date_key_sql()} AS date_key
    FROM {{o_meta}} m JOIN {{o_front}} f USING (document_id) JOIN {{o_t_best}} b USING (document_id)"""
ORACLES["parsed_documents"] = f"""
    SELECT document_id, metadata_document_id,
        document_id = metadata_document_id AS document_id_matches_metadata, title, creator, author,
        publication_date_raw, has_ocr_text, {DATE_COLUMNS}, date_source,
        date_parse_confidence AS date_confidence, date_key, metadata_parse_status FROM {{o_parsed}}"""
_DIM_DATES = f"""
    SELECT DISTINCT date_key, {DATE_COLUMNS}, {period_label_sql()} AS period_label,
        publication_year IS NOT NULL AS has_publication_year,
        publication_month IS NOT NULL AS has_publication_month,
        publication_day IS NOT NULL AS has_publication_day FROM """
ORACLES["dim_dates"] = _DIM_DATES + "{o_parsed}"
TABLES["o_creators"] = """
    SELECT document_id, unnest(creators) AS creator_name, 'creator' AS creator_source,
        generate_subscripts(creators, 1) - 1 AS creator_position FROM {o_meta}
    UNION ALL SELECT document_id, unnest(authors), 'author', generate_subscripts(authors, 1) - 1
        FROM {o_meta}
    UNION ALL SELECT document_id, 'Unknown', 'unknown', 0 FROM {o_meta}
        WHERE len(creators) = 0 AND len(authors) = 0"""
TABLES["o_subjects"] = """
    SELECT document_id, unnest(subjects) AS subject, 'metadata_subject' AS subject_source,
        generate_subscripts(subjects, 1) - 1 AS subject_position FROM {o_meta}
    UNION ALL SELECT document_id, 'Unknown', 'unknown', 0 FROM {o_meta} WHERE len(subjects) = 0"""
for _key, _name in (("creator", "creator_name"), ("subject", "subject")):
    ORACLES[f"dim_{_key}s"] = (
        f"SELECT <sha>lower(trim({_name}))</sha> AS {_key}_id, min({_name}) AS {_name} "
        f"FROM {{o_{_key}s}} GROUP BY 1"
    )
    ORACLES[f"bridge_{_key}s"] = (
        f"SELECT DISTINCT document_id, <sha>lower(trim({_name}))</sha> AS {_key}_id, "
        f"{_key}_source, cast({_key}_position AS int) AS {_key}_position FROM {{o_{_key}s}}"
    )
ORACLES["date_candidates_rule"] = """
    SELECT <sha>concat_ws('|', document_id, 'rule_based_selected', date_source)</sha> AS date_candidate_id,
        document_id, 'rule_based_metadata_title_ocr' AS extractor_name, '1' AS extractor_version,
        date_source AS candidate_source_field, publication_year AS candidate_publication_year,
        publication_month AS candidate_publication_month, publication_day AS candidate_publication_day,
        cast(publication_date AS varchar) AS candidate_publication_date,
        date_precision AS candidate_date_precision, date_calendar AS candidate_date_calendar,
        date_parse_confidence AS candidate_confidence,
        cast(NULL AS double) AS candidate_confidence_score, date_parse_notes AS candidate_evidence,
        substr('Metadata date: ' || coalesce(publication_date_raw, '') || chr(10) || 'Title: '
            || coalesce(title, '') || chr(10) || 'OCR front matter: ' || coalesce(ocr_front_matter, ''),
            1, 2500) AS source_text_excerpt, true AS selected_for_document
    FROM {o_parsed}"""
TABLES["o_facts"] = """
    SELECT document_id, date_key, has_ocr_text, publication_year IS NOT NULL AS has_valid_publication_year,
        publication_month IS NOT NULL AS has_publication_month,
        publication_day IS NOT NULL AS has_publication_day,
        metadata_parse_status = 'success' AS metadata_parse_success_flag,
        publication_year IS NOT NULL AND metadata_parse_status = 'success' AND has_ocr_text
            AS included_in_analysis_flag FROM {o_parsed}"""
ORACLES["fact_documents"] = "SELECT * FROM {o_facts}"

# ---- texts ----

_TEXT = r"""
    SELECT *, CASE WHEN character_count = 0 THEN 'empty_text' WHEN word_count < 100 THEN 'very_short_text'
        WHEN contains_encoding_artifacts THEN 'possible_encoding_artifacts' ELSE 'usable' END
        AS ocr_quality_flag
    FROM (SELECT *, lower(clean_text) AS clean_text_lower, cast(length(raw_text) AS int) AS character_count,
            cast(length(clean_text) AS int) AS clean_character_count,
            CASE WHEN clean_text = '' THEN 0 ELSE cast(len(string_split(clean_text, ' ')) AS int) END
                AS word_count,
            regexp_matches(raw_text, 'Ãƒ|Ã‚|Ã¢â‚¬|ï¿½') AS contains_encoding_artifacts
        FROM (SELECT *, trim(regexp_replace(raw_text, '\s+', ' ', 'g')) AS clean_text FROM {t_ocr}))"""
TABLES["o_text"] = _TEXT
TABLES["o_whole_text"] = _TEXT.replace("{t_ocr}", "(SELECT * EXCLUDE (source) FROM {t_texts})")
ORACLES["text_clean"] = "SELECT * EXCLUDE (raw_text) FROM {o_whole_text}"
TABLES["o_facts_text"] = """
    SELECT f.* EXCLUDE (included_in_analysis_flag), coalesce(word_count, 0) AS word_count,
        coalesce(character_count, 0) AS character_count,
        coalesce(clean_character_count, 0) AS clean_character_count,
        coalesce(contains_encoding_artifacts, false) AS contains_encoding_artifacts,
        coalesce(ocr_quality_flag, 'missing_ocr_text') AS ocr_quality_flag,
        has_valid_publication_year AND has_ocr_text
            AND coalesce(ocr_quality_flag, 'missing_ocr_text') <> 'empty_text' AS included_in_analysis_flag
    FROM {o_facts} f LEFT JOIN {o_text} USING (document_id)"""
ORACLES["fact_documents_text"] = "SELECT * FROM {o_facts_text}"
ORACLES["text_quality_summary"] = """
    SELECT ocr_quality_flag, count(*) AS document_count, min(word_count) AS min_word_count,
        quantile_disc(word_count, 0.5) AS median_word_count,
        round(avg(word_count), 9) AS avg_word_count, max(word_count) AS max_word_count,
        count(*) FILTER (contains_encoding_artifacts) AS documents_with_encoding_artifacts
    FROM {o_whole_text} GROUP BY 1"""

# ---- date candidates ----


def _field(name: str, part: str = "value") -> str:
    return f"json_extract_string(j, '$.response.{name}.{part}')"


TABLES["o_model"] = f"""
    SELECT <sha>concat_ws('|', document_id, 'model_extract', coalesce(cast(date AS varchar), ''),
            coalesce(cast(year AS varchar), ''), coalesce(cast(month AS varchar), ''),
            coalesce(cast(day AS varchar), ''), coalesce(p, ''), coalesce(c, ''),
            coalesce(evidence, ''))</sha> AS date_candidate_id,
        document_id, 'model_extract' AS extractor_name, '2.1' AS extractor_version,
        'combined_metadata_title_ocr_front_matter' AS candidate_source_field,
        year AS candidate_publication_year, month AS candidate_publication_month,
        day AS candidate_publication_day, cast(date AS varchar) AS candidate_publication_date,
        CASE WHEN p IN ('day', 'month', 'year') THEN p WHEN date IS NOT NULL THEN 'day'
            WHEN month IS NOT NULL AND year IS NOT NULL THEN 'month' WHEN year IS NOT NULL THEN 'year'
            ELSE 'unknown' END AS candidate_date_precision,
        CASE WHEN c LIKE '%republic%' THEN 'french_republican' WHEN c LIKE '%gregorian%' THEN 'gregorian'
            ELSE 'unknown' END AS candidate_date_calendar,
        CASE WHEN conf IN ('high', 'medium', 'low') THEN conf WHEN score >= 0.85 THEN 'high'
            WHEN score >= 0.65 THEN 'medium' ELSE 'low' END AS candidate_confidence,
        score AS candidate_confidence_score, evidence AS candidate_evidence,
        substr(extraction_input, 1, 2500) AS source_text_excerpt, false AS selected_for_document
    FROM (SELECT document_id, extraction_input, try_cast({_field("publication_year")} AS int) AS year,
            try_cast({_field("publication_month")} AS int) AS month,
            try_cast({_field("publication_day")} AS int) AS day,
            cast(coalesce(try_strptime({_field("publication_date")}, '%Y-%m-%d'),
                try_strptime({_field("publication_date")}, '%d %B %Y'),
                try_strptime({_field("publication_date")}, '%B %d %Y')) AS date) AS date,
            lower({_field("date_precision")}) AS p, lower({_field("calendar")}) AS c,
            lower({_field("confidence")}) AS conf, {_field("evidence")} AS evidence,
            greatest(coalesce(cast({_field("publication_date", "confidence_score")} AS double), 0),
                coalesce(cast({_field("publication_year", "confidence_score")} AS double), 0),
                coalesce(cast({_field("evidence", "confidence_score")} AS double), 0)) AS score
        FROM (SELECT *, CASE WHEN json_valid(extracted) THEN cast(extracted AS json) END AS j
            FROM {{x_replies}}))
    WHERE coalesce(cast(year AS varchar), cast(month AS varchar), cast(day AS varchar),
        cast(date AS varchar), evidence) IS NOT NULL"""
ORACLES["date_candidates_model"] = "SELECT * FROM {o_model}"
ORACLES["candidates_replace_by_source"] = """
    SELECT * EXCLUDE (source_text_excerpt) FROM {o_model}
    UNION ALL BY NAME
    SELECT * EXCLUDE (raw_extraction, source_text_excerpt)
        REPLACE (cast(candidate_publication_date AS varchar) AS candidate_publication_date)
    FROM {c_candidates} WHERE extractor_name <> 'model_extract'"""
TABLES["o_selected"] = f"""
    SELECT *, {date_key_sql()} AS date_key FROM (
      SELECT document_id, date_candidate_id AS selected_date_candidate_id,
        extractor_name AS selected_date_extractor_name,
        candidate_source_field AS selected_date_source_field,
        candidate_publication_year AS publication_year, candidate_publication_month AS publication_month,
        candidate_publication_day AS publication_day, candidate_publication_date AS publication_date,
        candidate_date_precision AS date_precision, candidate_date_calendar AS date_calendar,
        candidate_confidence AS selected_date_confidence,
        candidate_confidence_score AS selected_date_confidence_score,
        candidate_evidence AS selected_date_evidence,
        source_text_excerpt AS selected_date_source_text_excerpt, conflicts_with_metadata_year,
        CASE WHEN conflicts_with_metadata_year
            THEN 'selected candidate conflicts with metadata year; review before use'
            WHEN extractor_name = 'model_extract' AND candidate_date_precision IN ('day', 'month')
            THEN 'ai candidate selected for improved precision; review evidence'
            WHEN extractor_name = 'rule_based_metadata_title_ocr' THEN 'rule candidate selected'
            ELSE 'candidate selected by ranking' END AS selected_date_notes,
        row_number() OVER (PARTITION BY document_id ORDER BY conflicts_with_metadata_year,
            CASE candidate_date_precision WHEN 'day' THEN 3 WHEN 'month' THEN 2 ELSE 1 END DESC,
            CASE candidate_confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END DESC,
            CASE extractor_name WHEN 'rule_based_metadata_title_ocr' THEN 2 WHEN 'model_extract' THEN 1
                ELSE 0 END DESC,
            coalesce(candidate_confidence_score, 0) DESC, candidate_source_field, date_candidate_id) AS place
      FROM (SELECT c.*, coalesce(try_cast(regexp_extract(publication_date_raw, '1[5-9][0-9]{{2}}|20[0-9]{{2}}')
                AS int) <> candidate_publication_year, false) AS conflicts_with_metadata_year
            FROM {{c_candidates}} c JOIN {{c_keyed}} d ON c.document_id = d.document_id
            WHERE candidate_date_precision IN ('day', 'month', 'year')))
    WHERE place = 1"""
ORACLES["select_dates"] = (
    "SELECT * EXCLUDE (place) REPLACE (cast(publication_date AS varchar) AS publication_date) "
    "FROM {o_selected}"
)
ORACLES["candidates_marked"] = """
    SELECT c.date_candidate_id, c.document_id,
        coalesce(s.selected_date_candidate_id = c.date_candidate_id, false) AS selected_for_document
    FROM {c_candidates} c LEFT JOIN {o_selected} s ON c.document_id = s.document_id"""
TABLES["o_documents_selected"] = """
    SELECT d.document_id, coalesce(s.date_key, d.date_key) AS date_key, publication_date_raw,
        coalesce(selected_date_extractor_name, date_source) AS date_source,
        coalesce(selected_date_confidence, date_confidence) AS date_confidence,
        coalesce(selected_date_notes, date_parse_notes) AS date_parse_notes,
        selected_date_candidate_id, selected_date_source_field, selected_date_evidence,
        selected_date_source_text_excerpt,
        coalesce(conflicts_with_metadata_year, false) AS conflicts_with_metadata_year
    FROM {c_keyed} d LEFT JOIN {o_selected} s ON d.document_id = s.document_id"""
ORACLES["documents_with_selected_date"] = "SELECT * FROM {o_documents_selected}"
ORACLES["dates_after_selection"] = (
    _DIM_DATES + "{o_selected} UNION " + _DIM_DATES
    + "{c_keyed} WHERE date_key IN (SELECT date_key FROM {o_documents_selected})"
)
TABLES["o_facts_selected"] = """
    SELECT d.document_id, coalesce(s.date_key, d.date_key) AS date_key, o_orderstatus <> 'P' AS has_ocr_text,
        CASE WHEN o_totalprice < 100000 THEN 'empty_text' ELSE 'usable' END AS ocr_quality_flag,
        s.publication_year IS NOT NULL AS has_valid_publication_year,
        s.publication_month IS NOT NULL AS has_publication_month,
        s.publication_day IS NOT NULL AS has_publication_day,
        s.publication_year IS NOT NULL AND o_orderstatus <> 'P' AND o_totalprice >= 100000
            AND NOT coalesce(conflicts_with_metadata_year, false) AS included_in_analysis_flag
    FROM {c_keyed} d LEFT JOIN {o_selected} s ON d.document_id = s.document_id"""
ORACLES["facts_after_selection"] = "SELECT * FROM {o_facts_selected}"
ORACLES["mentions_after_selection"] = """
    SELECT mention_id, m.document_id, """ + ", ".join(
    f"CASE WHEN s.document_id IS NULL THEN m.{c} ELSE s.{c} END AS {c}"
    for c in ("date_key", "publication_year", "publication_month", "publication_day",
              "date_precision", "date_calendar")
) + """, cast(CASE WHEN s.document_id IS NULL THEN m.publication_date ELSE s.publication_date END AS varchar)
            AS publication_date,
        coalesce(f.included_in_analysis_flag, m.included_in_analysis_flag) AS included_in_analysis_flag,
        coalesce(f.included_in_analysis_flag, m.included_in_analysis_flag) AND m.figure_id IS NOT NULL
            AND NOT coalesce(conflicts_with_metadata_year, false) AND (CASE WHEN s.document_id IS NULL
            THEN m.publication_year ELSE s.publication_year END) IS NOT NULL AS is_analysis_ready,
        (CASE WHEN s.document_id IS NULL THEN m.publication_year ELSE s.publication_year END) IS NOT NULL
            AND coalesce(f.included_in_analysis_flag, m.included_in_analysis_flag)
            AND NOT coalesce(conflicts_with_metadata_year, false)
            AND coalesce(is_medium_or_high_stance_confidence, false) AS is_stance_ready
    FROM {m_mentions} m LEFT JOIN {o_selected} s ON m.document_id = s.document_id
        LEFT JOIN {o_facts_selected} f ON m.document_id = f.document_id"""

# ---- lexicon ----

TABLES["o_lexicon"] = r"""
    SELECT nullif(trim(figure_id), '') AS figure_id, nullif(trim(canonical_name), '') AS canonical_name,
        nullif(trim(variant), '') AS variant, trim(regexp_replace(lower(coalesce(
            nullif(trim(variant_normalized), ''), nullif(trim(variant), ''))), '\s+', ' ', 'g'))
            AS variant_normalized,
        variant_type, match_confidence, nullif(trim(notes), '') AS notes FROM {l_rows}"""
ORACLES["lexicon_scan"] = """
    SELECT figure_id, canonical_name, trim(variant) AS variant, variant_normalized, variant_type,
        match_confidence, nullif(trim(notes), '') AS notes FROM {l_rows}"""
TABLES["o_flawed"] = TABLES["o_lexicon"].replace("{l_rows}", "{l_flawed}")
ORACLES["lexicon_validate"] = """
    SELECT 'invalid_rows' AS check_name, count(*) AS violations FROM {o_flawed}
        WHERE figure_id IS NULL OR canonical_name IS NULL OR variant IS NULL OR variant_normalized IS NULL
            OR variant_normalized = '' OR match_confidence IS NULL
            OR match_confidence NOT IN ('high', 'medium', 'low')
    UNION ALL SELECT 'duplicate_variants', count(*) FROM (SELECT 1 FROM {o_flawed}
        GROUP BY figure_id, variant_normalized HAVING count(*) > 1)
    UNION ALL SELECT 'conflicting_figure_names', count(*) FROM (SELECT 1 FROM {o_flawed}
        GROUP BY figure_id HAVING count(DISTINCT canonical_name) > 1)"""
ORACLES["dim_figures"] = """
    SELECT figure_id, canonical_name, count(*) AS variant_count,
        count(*) FILTER (match_confidence = 'high') AS high_confidence_variant_count,
        count(*) FILTER (match_confidence = 'medium') AS medium_confidence_variant_count,
        count(*) FILTER (match_confidence = 'low') AS low_confidence_variant_count
    FROM {o_lexicon} GROUP BY 1, 2"""
ORACLES["dim_variants"] = """
    SELECT <sha>concat_ws('|', figure_id, variant_normalized)</sha> AS variant_id, figure_id, variant,
        variant_normalized, variant_type, match_confidence, notes FROM {o_lexicon}"""

# ---- mentions and contexts: runs of word and other characters with running offsets ----


def mention_select(texts: str) -> str:
    return rf"""
    WITH runs AS (SELECT document_id, unnest(r) AS run, generate_subscripts(r, 1) AS i FROM (
            SELECT document_id, regexp_extract_all(clean_text_lower, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+')
                AS r FROM {texts})),
        placed AS (SELECT *, sum(length(run)) OVER w - length(run) AS start,
            lead(run, 1) OVER w AS run2, lead(run, 2) OVER w AS run3
            FROM runs WINDOW w AS (PARTITION BY document_id ORDER BY i)),
        hits AS (SELECT document_id, cast(start AS int) AS match_start_char, v.* FROM placed
            JOIN {{w_variants}} v ON run = v.variant_normalized
            UNION ALL SELECT document_id, cast(start AS int), v.* FROM placed
            JOIN {{w_variants}} v ON run = split_part(v.variant_normalized, ' ', 1) AND run2 = ' '
                AND run3 = split_part(v.variant_normalized, ' ', 2)
            WHERE v.variant_normalized LIKE '% %')
    SELECT <sha>concat_ws('|', document_id, figure_id, variant_id, cast(match_start_char AS varchar),
            cast(match_start_char + length(variant_normalized) AS varchar))</sha> AS mention_id,
        document_id, match_start_char,
        cast(match_start_char + length(variant_normalized) AS int) AS match_end_char, figure_id,
        variant_id, variant AS matched_variant, variant_normalized, 'dictionary_regex' AS match_method
    FROM hits"""


def context_select(mentions: str, texts: str, before: int, after: int) -> str:
    return f"""
    SELECT mention_id, document_id, least(first, {before}) AS words_before_actual,
        cast(least(len(words) - 1 - last, {after}) AS int) AS words_after_actual,
        cast(hi - lo + 1 AS int) AS context_word_count,
        cast(length(array_to_string(words[1:lo], ' ')) + (CASE WHEN lo > 0 THEN 1 ELSE 0 END) AS int)
            AS context_start_char,
        cast(length(array_to_string(words[1:hi + 1], ' ')) AS int) AS context_end_char,
        array_to_string(words[lo + 1:hi + 1], ' ') AS context_window
    FROM (SELECT *, greatest(first - {before}, 0) AS lo,
            cast(least(last + {after}, len(words) - 1) AS int) AS hi
        FROM (SELECT mention_id, document_id, string_split(clean_text, ' ') AS words,
            cast(length(substr(clean_text, 1, match_start_char))
                - length(replace(substr(clean_text, 1, match_start_char), ' ', '')) AS int) AS first,
            cast(length(substr(clean_text, 1, match_end_char))
                - length(replace(substr(clean_text, 1, match_end_char), ' ', '')) AS int) AS last
            FROM {mentions} JOIN {texts} USING (document_id)))"""


TABLES["o_corpus"] = r"""
    SELECT *, lower(clean_text) AS clean_text_lower FROM (SELECT cast(doc_id AS varchar) AS document_id,
        trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean_text FROM {documents})"""
TABLES["o_found"] = mention_select("{o_corpus}")
ORACLES["mentions_extract"] = "SELECT * FROM {o_found}"
ORACLES["mentions_extract_routed"] = "SELECT * FROM {o_found}"
ORACLES["mention_contexts"] = (
    "SELECT * EXCLUDE (document_id) FROM ("
    + context_select("{o_found}", "{o_corpus}", 75, 75) + ")"
)
ORACLES["mention_contexts_joined"] = context_select("{o_found}", "{o_corpus}", 5, 5)
TABLES["o_found_ocr"] = mention_select("{o_text}")
ORACLES["fact_mentions"] = f"""
    SELECT mention_id, document_id, figure_id, variant_id, p.date_key,
        upper(figure_id) AS canonical_name, matched_variant, variant_normalized, 'title' AS variant_type,
        CASE figure_id WHEN 'links' THEN 'high' ELSE 'low' END AS match_confidence,
        figure_id = 'links' AS is_high_confidence_match, match_method, match_start_char, match_end_char,
        {DATE_COLUMNS}, f.ocr_quality_flag, f.included_in_analysis_flag,
        f.included_in_analysis_flag AND publication_year IS NOT NULL AS is_analysis_ready
    FROM {{o_found_ocr}} LEFT JOIN {{o_parsed}} p USING (document_id)
        LEFT JOIN {{o_facts_text}} f USING (document_id)"""

# ---- stance ----

TABLES["o_batch"] = """
    SELECT m.* FROM {m_mentions} m JOIN {m_contexts} c ON m.mention_id = c.mention_id
        LEFT JOIN (SELECT mention_id FROM {m_audit} WHERE model_stance_score_raw IS NOT NULL) a
            ON m.mention_id = a.mention_id
    WHERE a.mention_id IS NULL AND c.context_window <> '' AND m.is_analysis_ready"""
ORACLES["stance_batch_select"] = """
    SELECT mention_id, document_id, figure_id FROM {o_batch}
    ORDER BY publication_year NULLS FIRST, publication_month NULLS FIRST, figure_id, mention_id LIMIT 1000"""
ORACLES["stance_prompt"] = """
    SELECT b.mention_id, 'Classify.' || chr(10) || chr(10) || 'Target figure: ' || canonical_name || chr(10)
        || 'Matched variant: ' || matched_variant || chr(10) || 'Publication year: '
        || coalesce(cast(b.publication_year AS varchar), '') || chr(10) || 'Publication month: '
        || coalesce(cast(b.publication_month AS varchar), '') || chr(10) || 'Document title: '
        || coalesce(title, '') || chr(10) || chr(10) || 'Context window:' || chr(10) || context_window
        AS prompt
    FROM {o_batch} b JOIN {m_contexts} c ON b.mention_id = c.mention_id
        LEFT JOIN {m_documents} d ON b.document_id = d.document_id"""
TABLES["o_normalized"] = r"""
    SELECT *, CASE WHEN stance_label_raw IN ('positive', 'negative', 'neutral_or_unclear')
            THEN stance_label_raw ELSE 'neutral_or_unclear' END AS stance_label,
        CASE WHEN stance_label_raw NOT IN ('positive', 'negative') OR stance_label_raw IS NULL THEN 'none'
            WHEN stance_intensity_raw IN ('weak', 'moderate', 'strong') THEN stance_intensity_raw
            ELSE 'weak' END AS stance_intensity,
        CASE WHEN stance_confidence_raw IN ('high', 'medium', 'low') THEN stance_confidence_raw
            ELSE 'low' END AS stance_confidence,
        CASE WHEN target_relevance_raw IN ('direct', 'indirect', 'not_relevant')
            THEN target_relevance_raw ELSE 'not_relevant' END AS target_relevance
    FROM (SELECT mention_id, cleaned_raw_response,
            lower(json_extract_string(j, '$.stance_label')) AS stance_label_raw,
            lower(json_extract_string(j, '$.stance_intensity')) AS stance_intensity_raw,
            lower(json_extract_string(j, '$.stance_confidence')) AS stance_confidence_raw,
            lower(json_extract_string(j, '$.target_relevance')) AS target_relevance_raw,
            cast(json_extract_string(j, '$.stance_score') AS double) AS model_stance_score_raw,
            json_extract_string(j, '$.evidence_text') AS evidence_text,
            json_extract_string(j, '$.evidence_translation_en') AS evidence_translation_en,
            json_extract_string(j, '$.explanation') AS explanation
        FROM (SELECT *, CASE WHEN json_valid(cleaned_raw_response) THEN cast(cleaned_raw_response AS json)
                END AS j
            FROM (SELECT mention_id, trim(regexp_replace(regexp_replace(raw_response,
                '^```(?:json)?\s*', ''), '\s*```$', '')) AS cleaned_raw_response FROM {r_replies})))"""
ORACLES["stance_normalize"] = "SELECT * FROM {o_normalized}"
ORACLES["stance_score"] = """
    SELECT mention_id, <sha>concat_ws('|', mention_id, 'model', 'model-a')</sha> AS stance_audit_id,
        <sha>concat_ws('|', stance_label, stance_intensity, stance_confidence, target_relevance,
            'deterministic_label_intensity_mapping')</sha> AS stance_category_id,
        cast(CASE stance_label || ' ' || stance_intensity WHEN 'negative strong' THEN -1.0
            WHEN 'negative moderate' THEN -0.66 WHEN 'negative weak' THEN -0.33
            WHEN 'positive weak' THEN 0.33 WHEN 'positive moderate' THEN 0.66
            WHEN 'positive strong' THEN 1.0 ELSE 0.0 END AS double) AS stance_score,
        'deterministic_label_intensity_mapping' AS stance_score_method
    FROM {o_normalized}"""
ORACLES["model_score_column"] = """
    SELECT mention_id, CASE WHEN length(context_window) % 2 = 1 THEN 'positive' ELSE 'negative' END
        AS stance_label, 'weak' AS stance_intensity FROM {m_contexts}"""
ORACLES["model_extract_column"] = """
    SELECT document_id, cast(length('Metadata date: ' || coalesce(date_raw, '') || chr(10) || 'Title: '
        || coalesce(title, '') || chr(10) || 'OCR front matter: ' || coalesce(front_matter, '')) AS int)
        AS candidate_publication_year, 'year' AS candidate_date_precision FROM {d_texts}"""

# ---- sources, upserts, joins ----

# A file without content gives no row: the scan skips files of length zero.
ORACLES["scan_metadata_files"] = (
    "SELECT document_id, raw_metadata_xml FROM {t_metadata}"
)
ORACLES["scan_ocr_files"] = (
    "SELECT document_id, raw_text, source_file_type FROM {t_texts}"
)
ORACLES["write_nonempty"] = """
    SELECT * REPLACE (cast(publication_date AS varchar) AS publication_date) FROM {m_dates}
    WHERE has_publication_year"""
ORACLES["corpus_by_manifest"] = """
    SELECT document_id, file_path FROM {t_ocr}
    WHERE document_id IN (SELECT cast(doc_id AS varchar) FROM {labels})"""
ORACLES["evolve_schema"] = """
    SELECT mention_id, document_id, stance_score, cast(NULL AS varchar) AS stance_category_id,
        cast(NULL AS varchar) AS stance_audit_id, cast(NULL AS boolean) AS is_stance_scored,
        cast(NULL AS boolean) AS is_medium_or_high_stance_confidence,
        cast(NULL AS boolean) AS is_direct_or_indirect_relevance FROM {m_mentions}"""
ORACLES["merge_insert_only"] = "SELECT * FROM {m_categories}"
ORACLES["merge_upsert"] = """
    SELECT stance_audit_id, mention_id, evidence_text,
        CASE WHEN evidence_text IS NULL OR coalesce(model_stance_score_raw, 0) > 0 THEN 'again'
            ELSE explanation END AS explanation
    FROM {m_audit} WHERE evidence_text IS NULL OR model_stance_score_raw IS NOT NULL"""
ORACLES["merge_update_latest"] = """
    SELECT m.mention_id, m.document_id,
        CASE WHEN a.evidence_text IS NULL AND a.mention_id IS NOT NULL THEN 'gone' ELSE m.stance_category_id
            END AS stance_category_id,
        CASE WHEN a.evidence_text IS NULL AND a.mention_id IS NOT NULL THEN m.stance_audit_id || '-b'
            ELSE m.stance_audit_id END AS stance_audit_id,
        CASE WHEN a.evidence_text IS NULL AND a.mention_id IS NOT NULL THEN NULL ELSE m.stance_score
            END AS stance_score,
        m.is_stance_scored,
        CASE WHEN a.evidence_text IS NOT NULL THEN m.is_medium_or_high_stance_confidence
            END AS is_medium_or_high_stance_confidence,
        CASE WHEN a.evidence_text IS NOT NULL THEN m.is_direct_or_indirect_relevance
            END AS is_direct_or_indirect_relevance,
        cast(CASE WHEN a.mention_id IS NOT NULL AND a.evidence_text IS NULL THEN cast(ship_date + 1 AS date)
            ELSE ship_date END AS varchar) AS stance_updated_at
    FROM {m_mentions} m LEFT JOIN {m_audit} a ON m.mention_id = a.mention_id"""
ORACLES["join_star_left"] = """
    SELECT m.mention_id, m.document_id, m.date_key, m.stance_category_id, d.title, t.period_label,
        c.stance_label FROM {m_mentions} m LEFT JOIN {m_documents} d ON m.document_id = d.document_id
        LEFT JOIN {m_dates} t ON m.date_key = t.date_key
        LEFT JOIN {m_categories} c ON m.stance_category_id = c.stance_category_id"""
ORACLES["join_anti_resumable"] = """
    SELECT mention_id, figure_id FROM {m_mentions} m WHERE NOT EXISTS (SELECT 1 FROM {m_audit} a
        WHERE a.mention_id = m.mention_id AND evidence_text IS NOT NULL)"""
ORACLES["join_null_safe"] = """
    SELECT l.*, o.documents FROM (SELECT publication_year, publication_month, count(*) AS mentions
            FROM {m_mentions} GROUP BY 1, 2) l
        LEFT JOIN (SELECT publication_year, publication_month, count(*) AS documents
            FROM {m_documents} GROUP BY 1, 2) o
        ON l.publication_year IS NOT DISTINCT FROM o.publication_year
            AND l.publication_month IS NOT DISTINCT FROM o.publication_month"""
ORACLES["join_bridge_expand"] = """
    SELECT d.document_id, title, creator_id, creator_source, count(*) AS member_weight
    FROM {m_documents} d LEFT JOIN {m_bridge_creators} b ON d.document_id = b.document_id
    GROUP BY ALL"""

# ---- gold ----


def ratio(name: str, top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} > 0 THEN cast({top} AS double) / {bottom} END AS {name}"


def when(condition: str, name: str) -> str:
    return f"count(*) FILTER ({condition}) AS {name}"


def rounded(value: str) -> str:
    """Nine decimals without a negative zero."""
    return f"CASE WHEN abs({value}) < 5e-10 THEN 0.0 ELSE round({value}, 9) END"


def mean(absolute: bool = False) -> str:
    """Average score of the included rows; summed as decimals, so order plays no part."""
    score = "abs(stance_score)" if absolute else "stance_score"
    total = f"cast(sum(cast({score} AS decimal(8, 6))) FILTER (inc) AS double)"
    return f"{total} / nullif(count(*) FILTER (inc), 0)"


TABLES["o_rows"] = """
    SELECT m.* EXCLUDE (publication_year, publication_month, publication_day, publication_date,
            date_precision, date_calendar),
        t.* EXCLUDE (date_key), c.stance_label, c.stance_intensity, c.stance_confidence,
        c.target_relevance, c.stance_score_method,
        c.stance_confidence IN ('medium', 'high') AND m.stance_score IS NOT NULL AS inc
    FROM {m_mentions} m LEFT JOIN {m_dates} t ON m.date_key = t.date_key
        LEFT JOIN {m_categories} c ON m.stance_category_id = c.stance_category_id"""

_LABELS = [
    when(f"inc AND stance_label = '{v}'", f"{v}_mention_count")
    for v in ("positive", "negative", "neutral_or_unclear")
]
_INTENSITIES = [
    when(f"inc AND stance_intensity = '{v}'", f"{v}_stance_mention_count")
    for v in ("weak", "moderate", "strong")
]
_RELEVANCES = [
    when(f"target_relevance = '{v}'", f"{v}_mention_count")
    for v in ("direct", "indirect", "not_relevant")
]
_COUNTS = ", ".join(
    [
        "count(*) AS mention_count",
        when("inc", "included_mention_count"),
        *_LABELS,
        *_INTENSITIES,
        when("inc AND stance_label = 'negative' AND stance_intensity = 'strong'",
             "strong_negative_mention_count"),
        *[when(f"stance_confidence = '{v}'", f"{v}_confidence_count") for v in ("high", "medium", "low")],
        *_RELEVANCES,
        *[when(f"inc AND target_relevance = '{v}'", f"included_{v}_mention_count")
          for v in ("direct", "indirect", "not_relevant")],
    ]
)
_SHARES = ", ".join(
    [
        ratio("included_mention_share", "included_mention_count", "mention_count"),
        ratio("positive_mention_share", "positive_mention_count", "included_mention_count"),
        ratio("negative_mention_share", "negative_mention_count", "included_mention_count"),
        ratio("neutral_or_unclear_mention_share", "neutral_or_unclear_mention_count",
              "included_mention_count"),
        ratio("strong_negative_mention_share", "strong_negative_mention_count",
              "included_mention_count"),
        ratio("direct_relevance_share", "included_direct_mention_count", "included_mention_count"),
    ]
)
_SPAN = (
    "cast(min(publication_date) AS varchar) AS min_publication_date, "
    "cast(max(publication_date) AS varchar) AS max_publication_date"
)
_PERIOD = "period_label, publication_year, publication_month, figure_id, canonical_name"

TABLES["o_gold_mentions"] = f"""
    SELECT *, match_confidence = 'high' AS is_high_confidence_match_group,
        publication_year IS NOT NULL AND analysis_ready_mention_count > 0 AS is_analysis_ready,
        {ratio("included_stance_mention_share", "included_stance_mention_count", "mention_count")},
        {ratio("positive_mention_share", "positive_mention_count", "included_stance_mention_count")},
        {ratio("negative_mention_share", "negative_mention_count", "included_stance_mention_count")},
        {ratio("neutral_or_unclear_mention_share", "neutral_or_unclear_mention_count",
               "included_stance_mention_count")}
    FROM (SELECT {_PERIOD}, date_precision, date_calendar, match_confidence, count(*) AS mention_count,
            count(DISTINCT document_id) AS document_count,
            count(DISTINCT variant_id) AS matched_variant_count,
            {when("is_high_confidence_match", "high_confidence_match_count")},
            {when("is_analysis_ready", "analysis_ready_mention_count")},
            count(DISTINCT document_id) FILTER (is_analysis_ready) AS analysis_ready_document_count,
            {when("inc", "included_stance_mention_count")},
            count(DISTINCT document_id) FILTER (inc) AS included_stance_document_count,
            {", ".join(_LABELS + _INTENSITIES + _RELEVANCES)},
            {", ".join(when(f"stance_confidence = '{v}'", f"{v}_stance_confidence_count")
                       for v in ("high", "medium", "low"))}, {_SPAN}
        FROM {{o_rows}} GROUP BY {_PERIOD}, date_precision, date_calendar, match_confidence)"""
ORACLES["gold_mentions_by_period"] = "SELECT * FROM {o_gold_mentions}"

TABLES["o_period_mentions"] = f"""
    SELECT {_PERIOD}, {_COUNTS}, count(DISTINCT document_id) AS document_count,
        count(DISTINCT document_id) FILTER (inc) AS included_document_count,
        {rounded(mean())} AS avg_stance_score_mention_weighted,
        {rounded(mean(True))} AS avg_abs_stance_score_mention_weighted,
        {", ".join(when(f"date_precision = '{p}'", f"{p}_precision_count")
                   for p in ("day", "month", "year"))}, {_SPAN}
    FROM {{o_rows}} GROUP BY {_PERIOD}"""
TABLES["o_period_documents"] = f"""
    SELECT {_PERIOD}, {rounded('avg(s)')} AS avg_stance_score_document_weighted,
        {rounded('avg(a)')} AS avg_abs_stance_score_document_weighted,
        {when("s > 0", "positive_document_count")}, {when("s < 0", "negative_document_count")},
        {when("s = 0", "neutral_document_count")}
    FROM (SELECT {_PERIOD}, document_id, {mean()} AS s, {mean(True)} AS a
        FROM {{o_rows}} GROUP BY {_PERIOD}, document_id) GROUP BY {_PERIOD}"""


def period_select(equal: str) -> str:
    condition = " AND ".join(f"m.{k} {equal} d.{k}" for k in _PERIOD.split(", "))
    keys = ", ".join(_PERIOD.split(", "))
    return f"""
    SELECT m.*, d.* EXCLUDE ({keys}), avg_stance_score_document_weighted AS avg_stance_score,
        avg_abs_stance_score_document_weighted AS avg_abs_stance_score, {_SHARES},
        {ratio("included_document_share", "included_document_count", "document_count")},
        m.publication_year IS NOT NULL AND included_mention_count > 0 AS is_analysis_ready
    FROM {{o_period_mentions}} m LEFT JOIN {{o_period_documents}} d ON {condition}"""


TABLES["o_gold_period"] = period_select("IS NOT DISTINCT FROM")
ORACLES["gold_stance_by_period"] = "SELECT * FROM {o_gold_period}"
ORACLES["gold_stance_by_period_plain_keys"] = period_select("=")

_ATTRIBUTES = (
    "title, creator, author, language, internet_archive_id, source_url, metadata_parse_status"
)
TABLES["o_by_document"] = f"""
    SELECT g.*, {", ".join("d." + a for a in _ATTRIBUTES.split(", "))},
        coalesce(d.conflicts_with_metadata_year, false) AS has_metadata_year_conflict, t.period_label,
        t.publication_year, t.publication_month, t.publication_day, t.publication_date,
        t.date_precision, t.date_calendar,
        CASE WHEN avg_score > 0 THEN 'positive' WHEN avg_score < 0 THEN 'negative'
            WHEN included_mention_count > 0 THEN 'neutral' ELSE 'not_included' END AS document_stance_label,
        {_SHARES}, t.publication_year IS NOT NULL AND included_mention_count > 0
            AND NOT coalesce(d.conflicts_with_metadata_year, false) AS is_analysis_ready
    FROM (SELECT document_id, figure_id, canonical_name, any_value(date_key) AS date_key,
            any_value(ocr_quality_flag) AS ocr_quality_flag, {_COUNTS},
            {mean()} AS avg_score, {mean(True)} AS avg_abs,
            min(stance_score) FILTER (inc) AS min_stance_score,
            max(stance_score) FILTER (inc) AS max_stance_score
        FROM {{o_rows}} GROUP BY document_id, figure_id, canonical_name) g
        LEFT JOIN {{m_documents}} d ON g.document_id = d.document_id
        LEFT JOIN {{m_dates}} t ON g.date_key = t.date_key"""
ORACLES["gold_stance_by_document"] = """
    SELECT * EXCLUDE (date_key, avg_score, avg_abs)
        REPLACE (cast(publication_date AS varchar) AS publication_date),
        round(avg_score, 9) AS avg_stance_score, round(avg_abs, 9) AS avg_abs_stance_score
    FROM {o_by_document}"""

_SUMMED = [
    "mention_count", "included_mention_count", "positive_mention_count", "negative_mention_count",
    "neutral_or_unclear_mention_count", "weak_stance_mention_count", "moderate_stance_mention_count",
    "strong_stance_mention_count", "strong_negative_mention_count", "high_confidence_count",
    "medium_confidence_count", "low_confidence_count", "direct_mention_count",
    "indirect_mention_count", "not_relevant_mention_count", "included_direct_mention_count",
    "included_indirect_mention_count", "included_not_relevant_mention_count",
]


def member_select(bridge: str, members: str, key: str, name: str) -> str:
    keys = f"{_PERIOD}, {key}_id, {name}, {key}_source"
    return f"""
    SELECT *, {_SHARES},
        {ratio("analysis_ready_document_share", "analysis_ready_document_count", "document_count")},
        publication_year IS NOT NULL AND analysis_ready_document_count > 0 AS is_analysis_ready
    FROM (SELECT {keys}, count(DISTINCT document_id) AS document_count,
            {", ".join(f"cast(sum({c}) AS bigint) AS {c}" for c in _SUMMED)},
            {rounded('avg(avg_score) FILTER (is_analysis_ready)')} AS avg_stance_score,
            {rounded('avg(avg_abs) FILTER (is_analysis_ready)')} AS avg_abs_stance_score,
            {", ".join(when(f"is_analysis_ready AND document_stance_label = '{v}'", f"{v}_document_count")
                       for v in ("positive", "negative", "neutral"))},
            {when("is_analysis_ready", "analysis_ready_document_count")},
            {when("NOT is_analysis_ready", "not_analysis_ready_document_count")}, {_SPAN}
        FROM (SELECT d.*, b.{key}_id, b.{key}_source, coalesce(n.{name}, 'Unknown') AS {name}
            FROM {{o_by_document}} d LEFT JOIN {bridge} b ON d.document_id = b.document_id
                LEFT JOIN {members} n ON b.{key}_id = n.{key}_id)
        GROUP BY {keys})"""


TABLES["o_gold_creator"] = member_select(
    "{m_bridge_creators}", "{m_creators}", "creator", "creator_name")
TABLES["o_gold_subject"] = member_select(
    "{m_bridge_subjects}", "{m_subjects}", "subject", "subject")
ORACLES["gold_stance_by_creator"] = "SELECT * FROM {o_gold_creator}"
ORACLES["gold_stance_by_subject"] = "SELECT * FROM {o_gold_subject}"

_TIES = "confidence_rank DESC, relevance_rank DESC, document_id, mention_id"
_GROUP = "PARTITION BY figure_id, publication_year, publication_month"
TABLES["o_gold_top"] = f"""
    SELECT stance_audit_id, mention_id, document_id, figure_id, canonical_name, {_ATTRIBUTES},
        period_label, {DATE_COLUMNS}, publication_day AS _day, conflicts_with_metadata_year,
        matched_variant, variant_type, match_confidence, match_method, stance_method, stance_model,
        stance_label, stance_intensity, stance_score, abs_stance_score, stance_score_method,
        model_stance_score_raw, stance_confidence, target_relevance, evidence_text,
        evidence_translation_en, explanation, context_window, context_word_count, context_start_char,
        context_end_char, ocr_quality_flag,
        cast(row_number() OVER ({_GROUP} ORDER BY abs_stance_score DESC, {_TIES}) AS int)
            AS absolute_stance_rank_by_figure_period,
        CASE WHEN stance_label = 'positive' THEN cast(row_number() OVER (
            {_GROUP} ORDER BY stance_score DESC, {_TIES}) AS int) END AS positive_rank_by_figure_period,
        CASE WHEN stance_label = 'negative' THEN cast(row_number() OVER (
            {_GROUP} ORDER BY stance_score, {_TIES}) AS int) END AS negative_rank_by_figure_period,
        publication_year IS NOT NULL AND NOT coalesce(conflicts_with_metadata_year, false)
            AS is_analysis_ready
    FROM (SELECT r.*, {", ".join("d." + a for a in _ATTRIBUTES.split(", "))},
            d.conflicts_with_metadata_year, c.context_window, c.context_word_count,
            c.context_start_char, c.context_end_char, a.stance_method, a.stance_model,
            a.model_stance_score_raw, a.evidence_text, a.evidence_translation_en, a.explanation,
            abs(stance_score) AS abs_stance_score,
            CASE stance_confidence WHEN 'high' THEN 2 ELSE 1 END AS confidence_rank,
            CASE target_relevance WHEN 'direct' THEN 2 ELSE 1 END AS relevance_rank
        FROM {{o_rows}} r LEFT JOIN {{m_documents}} d ON r.document_id = d.document_id
            LEFT JOIN {{m_contexts}} c ON r.mention_id = c.mention_id
            LEFT JOIN {{m_audit}} a ON r.stance_audit_id = a.stance_audit_id
                AND r.mention_id = a.mention_id
        WHERE stance_confidence IN ('medium', 'high') AND target_relevance IN ('direct', 'indirect')
            AND length(trim(a.evidence_text)) > 0)"""
ORACLES["gold_top_contexts"] = "SELECT * EXCLUDE (_day) FROM {o_gold_top}"

# ---- quality ----

ORACLES["mention_summary"] = """
    SELECT figure_id, canonical_name, matched_variant, variant_type, match_confidence,
        count(*) AS mention_count, count(DISTINCT document_id) AS document_count,
        min(publication_year) AS min_publication_year, max(publication_year) AS max_publication_year
    FROM {m_mentions} GROUP BY 1, 2, 3, 4, 5"""
ORACLES["stance_distribution"] = """
    SELECT figure_id, canonical_name, c.stance_label, c.stance_intensity, c.stance_score,
        c.stance_confidence, c.target_relevance, count(*) AS stance_row_count,
        count(DISTINCT document_id) AS document_count, count(DISTINCT mention_id) AS mention_count,
        round(avg(abs(c.stance_score)), 9) AS avg_abs_stance_score
    FROM {m_mentions} m LEFT JOIN {m_categories} c ON m.stance_category_id = c.stance_category_id
    GROUP BY 1, 2, 3, 4, 5, 6, 7"""


def _metric(group: str, name: str, source: str, condition: str = "true") -> str:
    return (
        f"SELECT '{group}' AS metric_group, '{name}' AS metric_name, "
        f"count(*) FILTER ({condition}) AS metric_value FROM {source}"
    )


def _nested(name: str) -> str:
    return f"({ORACLES[name]})"


def _quality() -> str:
    facts, star = "{o_facts_text}", "{m_mentions}"
    flags = {
        "usable_ocr_documents": "usable",
        "very_short_text_documents": "very_short_text",
        "empty_text_documents": "empty_text",
        "possible_encoding_artifact_documents": "possible_encoding_artifacts",
    }
    candidates = "{c_candidates}"
    selected = _nested("candidates_marked")
    model = "extractor_name = 'model_extract'"
    marked = (
        f"(SELECT c.extractor_name, s.selected_for_document FROM {candidates} c "
        f"JOIN {selected} s USING (date_candidate_id))"
    )
    rows = [
        ("bronze", "bronze_metadata_rows", "{t_metadata}"),
        ("bronze", "bronze_ocr_text_rows", "{t_ocr}"),
        ("documents", "silver_dim_documents_rows", "{m_documents}"),
        ("documents", "documents_with_creator", "{m_documents}", "creator IS NOT NULL"),
        ("documents", "documents_with_author", "{m_documents}", "author IS NOT NULL"),
        ("documents", "documents_with_metadata_year_conflict", "{m_documents}",
         "conflicts_with_metadata_year"),
        ("documents", "silver_fact_documents_rows", facts),
        ("documents", "documents_with_ocr_text", facts, "has_ocr_text"),
        ("documents", "documents_without_ocr_text", facts, "NOT has_ocr_text"),
        ("documents", "documents_with_valid_publication_year", facts, "has_valid_publication_year"),
        ("documents", "documents_with_publication_month", facts, "has_publication_month"),
        ("documents", "documents_with_publication_day", facts, "has_publication_day"),
        ("documents", "analysis_ready_documents", facts, "included_in_analysis_flag"),
        ("documents", "metadata_parse_success_documents", facts, "metadata_parse_success_flag"),
        *[("text_quality", name, facts, f"ocr_quality_flag = '{flag}'") for name, flag in flags.items()],
        ("text_quality", "documents_with_encoding_artifacts", facts, "contains_encoding_artifacts"),
        ("text_quality", "silver_dim_document_text_rows", "{t_ocr}"),
        ("dates", "silver_dim_dates_rows", _nested("dim_dates")),
        ("dates", "silver_publication_date_candidate_rows", candidates),
        ("dates", "rule_based_publication_date_candidates", candidates,
         "extractor_name = 'rule_based_metadata_title_ocr'"),
        ("dates", "ai_publication_date_candidates", candidates, model),
        ("dates", "selected_publication_date_candidates", marked, "selected_for_document"),
        ("dates", "selected_ai_publication_date_candidates", marked,
         f"selected_for_document AND {model}"),
        ("creators", "creator_rows", _nested("dim_creators")),
        ("creators", "document_creator_bridge_rows", _nested("bridge_creators")),
        ("creators", "unknown_creator_bridge_rows", _nested("bridge_creators"),
         "creator_source = 'unknown'"),
        ("subjects", "subject_rows", _nested("dim_subjects")),
        ("subjects", "document_subject_bridge_rows", _nested("bridge_subjects")),
        ("subjects", "unknown_subject_bridge_rows", _nested("bridge_subjects"),
         "subject_source = 'unknown'"),
        ("figures", "distinct_figures", _nested("dim_figures")),
        ("figures", "figure_variant_rows", "{o_lexicon}"),
        ("mentions", "silver_fact_figure_mentions_rows", star),
        *[("mentions", f"{v}_confidence_mentions", star, f"match_confidence = '{v}'")
          for v in ("high", "medium", "low")],
        ("mentions", "analysis_ready_mentions", star, "is_analysis_ready"),
        ("contexts", "silver_dim_mention_contexts_rows", "{m_contexts}"),
        ("contexts", "empty_mention_contexts", "{m_contexts}", "context_window = ''"),
        ("stance", "silver_dim_stance_category_rows", "{m_categories}"),
        ("stance", "silver_stance_model_audit_rows", "{m_audit}"),
        ("stance", "stance_scored_mentions", star, "is_stance_scored"),
        ("stance", "medium_high_confidence_stance_mentions", star,
         "is_medium_or_high_stance_confidence"),
        ("stance", "direct_or_indirect_relevance_mentions", star,
         "is_direct_or_indirect_relevance"),
        ("gold", "gold_figure_mentions_by_period_rows", "{o_gold_mentions}"),
    ]
    for source, table, ready in (
        ("{o_gold_period}", "gold_figure_stance_by_period", "figure_stance_period_rows"),
        ("{o_by_document}", "gold_figure_stance_by_document", "figure_stance_document_rows"),
        ("{o_gold_top}", "gold_top_stance_contexts", "top_stance_context_rows"),
        ("{o_gold_creator}", "gold_figure_stance_by_creator_period", "creator_period_rows"),
        ("{o_gold_subject}", "gold_figure_stance_by_subject_period", "subject_period_rows"),
    ):
        rows.append(("gold", f"{table}_rows", source))
        rows.append(("gold", f"analysis_ready_{ready}", source, "is_analysis_ready"))
    return " UNION ALL ".join(_metric(*row) for row in rows)


ORACLES["write_ordered"] = """
    SELECT publication_year, figure_id, mention_id, row_number() OVER (
        ORDER BY publication_year DESC NULLS LAST, figure_id ASC NULLS FIRST, mention_id ASC NULLS FIRST) AS place
    FROM {m_mentions}"""
ORACLES["dim_figures_stamped"] = """
    SELECT f.*, s.loaded_at FROM (""" + ORACLES["dim_figures"] + """) f JOIN (
        SELECT figure_id, '1790-01-' || lpad(cast(min(length(variant)) AS varchar), 2, '0') AS loaded_at
        FROM {l_rows} GROUP BY 1) s ON f.figure_id = s.figure_id"""
ORACLES["model_reply_cache"] = """
    SELECT p_partkey, CASE WHEN NOT contains(p_name, 'rod') THEN '{"stance_label": "'
            || CASE length(p_name) % 2 WHEN 1 THEN 'positive' ELSE 'negative' END || '"}' END AS raw_response,
        CASE WHEN contains(p_name, 'rod') THEN 'RuntimeError: refused' END AS error
    FROM {part}"""
for _stored, _plain in {
    "merge_upsert_parts": "merge_upsert",
    "merge_update_latest_parts": "merge_update_latest",
    "mention_contexts_colocated": "mention_contexts_joined",
    "gold_refreshed_mentions_by_period": "gold_mentions_by_period",
    "gold_refreshed_stance_by_period": "gold_stance_by_period",
    "gold_refreshed_stance_by_document": "gold_stance_by_document",
    "gold_refreshed_stance_by_creator": "gold_stance_by_creator",
    "gold_refreshed_stance_by_subject": "gold_stance_by_subject",
    "gold_refreshed_top_contexts": "gold_top_contexts",
}.items():
    ORACLES[_stored] = ORACLES[_plain]
ORACLES["quality_metrics"] = _quality()


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(text, TABLES) for name, text in ORACLES.items()}
