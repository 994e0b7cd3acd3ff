"""Domain tables derived from the given tables.

Every definition is one SQL text that Spark and DuckDB read alike, so both sides of
a comparison start from the same rows. ``{name}`` stands for a given table or an
earlier definition; ``<sha>x</sha>`` is the hexadecimal SHA-256 of x.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from rostra.sources.tables import spread

GIVEN = ("lineitem", "orders", "customer", "supplier", "part", "documents", "labels", "events")

# Tables whose rows are costly to work on.
COSTLY = ("documents", "events", "lineitem", "orders")

# Month names as they are written into rendered dates.
FRENCH = "janvier février mars avril mai juin juillet août septembre octobre novembre décembre"
REPUBLICAN = (
    "vendémiaire brumaire frimaire nivôse pluviôse ventôse germinal floréal prairial "
    "messidor thermidor fructidor"
)
ROMAN = "I II III IV V VI VII VIII IX X XI XII XIII XIV XV"


def pick(words: str, index: str) -> str:
    """CASE expression: the index-th (from 1) of the words."""
    cases = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words.split(), start=1))
    return f"CASE {index} {cases} END"


DATE_KEY = """<sha>concat_ws('|', coalesce(cast({y} AS string), 'unknown'),
    coalesce(cast({m} AS string), 'unknown'), coalesce(cast({d} AS string), 'unknown'),
    coalesce({p}, 'unknown'), coalesce({c}, 'unknown'))</sha>"""


def date_key_sql(prefix: str = "", y="publication_year", m="publication_month",
                 d="publication_day", p="date_precision", c="date_calendar") -> str:
    return DATE_KEY.format(y=prefix + y, m=prefix + m, d=prefix + d, p=prefix + p, c=prefix + c)


def period_label_sql(y="publication_year", m="publication_month") -> str:
    return (
        f"CASE WHEN {y} IS NULL THEN 'Unknown' WHEN {m} IS NULL THEN cast({y} AS string) "
        f"ELSE concat(cast({y} AS string), '-', lpad(cast({m} AS string), 2, '0')) END"
    )


DEFINITIONS = {
    # ---- mention star: one order is a document, one line item is a mention ----
    "m_documents_raw": """
        SELECT cast(o_orderkey AS string) AS document_id, o_orderstatus, o_orderpriority, o_custkey,
            CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN cast(year(o_orderdate) AS int) END
                AS publication_year,
            CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')
                THEN cast(month(o_orderdate) AS int) END AS publication_month,
            CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW')
                THEN cast(day(o_orderdate) AS int) END AS publication_day,
            CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW')
                THEN cast(o_orderdate AS date) END AS publication_date,
            CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'day'
                WHEN o_orderpriority = '2-HIGH' THEN 'month'
                WHEN o_orderpriority = '3-MEDIUM' THEN 'year' ELSE 'unknown' END AS date_precision,
            CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown' ELSE 'gregorian' END
                AS date_calendar
        FROM {orders}""",
    "m_documents": """
        SELECT document_id, concat('Adresse ', document_id) AS title,
            CASE WHEN o_orderstatus <> 'F' THEN c_name END AS creator, c_name AS author,
            o_orderpriority AS language, concat('ia-', document_id) AS internet_archive_id,
            concat('http://example.org/', document_id) AS source_url,
            'success' AS metadata_parse_status,
            CASE WHEN o_orderstatus = 'O' THEN cast(NULL AS boolean) ELSE o_orderstatus = 'P' END
                AS conflicts_with_metadata_year,
            publication_year, publication_month, publication_day, publication_date,
            date_precision, date_calendar,
            """ + date_key_sql() + """ AS date_key,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'possible_encoding_artifacts'
                WHEN '5-LOW' THEN 'very_short_text' ELSE 'usable' END AS ocr_quality_flag,
            o_orderstatus <> 'P' AS included_in_analysis_flag
        FROM {m_documents_raw} LEFT JOIN {customer} ON o_custkey = c_custkey""",
    "m_dates": """
        SELECT DISTINCT date_key, publication_year, publication_month, publication_day,
            publication_date, date_precision, date_calendar,
            """ + period_label_sql() + """ AS period_label,
            publication_year IS NOT NULL AS has_publication_year,
            publication_month IS NOT NULL AS has_publication_month,
            publication_day IS NOT NULL AS has_publication_day
        FROM {m_documents}""",
    "m_lines": """
        SELECT concat_ws('|', cast(l_orderkey AS string), cast(l_linenumber AS string),
                cast(l_partkey AS string), cast(l_suppkey AS string),
                cast(cast(round(l_extendedprice * 100) AS bigint) AS string),
                cast(cast(l_shipdate AS date) AS string)) AS mention_id,
            cast(l_orderkey AS string) AS document_id, l_suppkey, l_linenumber, l_linestatus,
            p_type AS figure_id, concat('Figure ', p_type) AS canonical_name,
            p_brand AS variant_id, p_brand AS matched_variant, lower(p_brand) AS variant_normalized,
            CASE WHEN length(p_brand) = 7 THEN 'title' ELSE 'proper_name' END AS variant_type,
            CASE WHEN l_quantity <= 16 THEN 'low' WHEN l_quantity <= 33 THEN 'medium'
                ELSE 'high' END AS match_confidence,
            p_name, cast(round(l_discount * 100) AS int) AS discount,
            l_linenumber < 7 AS is_scored,
            CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative'
                ELSE 'neutral_or_unclear' END AS stance_label,
            CASE WHEN l_returnflag NOT IN ('A', 'R') THEN 'none'
                WHEN round(l_discount * 100) <= 3 THEN 'weak'
                WHEN round(l_discount * 100) <= 7 THEN 'moderate' ELSE 'strong' END
                AS stance_intensity,
            CASE WHEN round(l_tax * 100) < 3 THEN 'low' WHEN round(l_tax * 100) < 6 THEN 'medium'
                ELSE 'high' END AS stance_confidence,
            CASE WHEN l_linestatus = 'O' THEN 'direct' WHEN l_linenumber <= 2 THEN 'not_relevant'
                ELSE 'indirect' END AS target_relevance,
            cast(l_shipdate AS date) AS ship_date
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "m_scored": """
        SELECT *,
            CASE WHEN is_scored THEN <sha>concat_ws('|', stance_label, stance_intensity,
                stance_confidence, target_relevance, 'deterministic_label_intensity_mapping')</sha>
                END AS stance_category_id,
            CASE WHEN is_scored THEN <sha>concat_ws('|', mention_id, 'model', 'model-a')</sha> END
                AS stance_audit_id,
            CASE WHEN NOT is_scored THEN cast(NULL AS double)
                WHEN stance_label = 'neutral_or_unclear' THEN cast(0.0 AS double)
                ELSE (CASE stance_label WHEN 'negative' THEN cast(-1 AS double) ELSE cast(1 AS double) END)
                    * (CASE stance_intensity WHEN 'weak' THEN cast(0.33 AS double)
                        WHEN 'moderate' THEN cast(0.66 AS double) ELSE cast(1.0 AS double) END)
                END AS stance_score
        FROM {m_lines}""",
    "m_mentions": """
        SELECT m.mention_id, m.document_id, m.figure_id, m.variant_id, d.date_key,
            m.canonical_name, m.matched_variant, m.variant_normalized, m.variant_type,
            m.match_confidence, m.match_confidence = 'high' AS is_high_confidence_match,
            'dictionary_regex' AS match_method, m.l_linenumber * 10 AS match_start_char,
            m.l_linenumber * 10 + length(m.variant_normalized) AS match_end_char,
            d.publication_year, d.publication_month, d.publication_day, d.publication_date,
            d.date_precision, d.date_calendar, d.ocr_quality_flag, d.included_in_analysis_flag,
            (d.included_in_analysis_flag AND d.publication_year IS NOT NULL
                AND m.figure_id IS NOT NULL) AS is_analysis_ready,
            m.stance_category_id, m.stance_audit_id, m.stance_score,
            CASE WHEN m.is_scored THEN true END AS is_stance_scored,
            CASE WHEN m.is_scored THEN m.stance_confidence IN ('medium', 'high') END
                AS is_medium_or_high_stance_confidence,
            CASE WHEN m.is_scored THEN m.target_relevance IN ('direct', 'indirect') END
                AS is_direct_or_indirect_relevance
        FROM {m_scored} m LEFT JOIN {m_documents} d ON m.document_id = d.document_id""",
    "m_labels": """
        SELECT DISTINCT stance_label, stance_intensity, stance_confidence, target_relevance
        FROM {m_lines} WHERE is_scored""",
    "m_categories": """
        SELECT <sha>concat_ws('|', stance_label, stance_intensity, stance_confidence,
                target_relevance, 'deterministic_label_intensity_mapping')</sha> AS stance_category_id,
            stance_label, stance_intensity, stance_confidence, target_relevance,
            'deterministic_label_intensity_mapping' AS stance_score_method,
            CASE WHEN stance_label = 'neutral_or_unclear' THEN cast(0.0 AS double)
                ELSE (CASE stance_label WHEN 'negative' THEN cast(-1 AS double) ELSE cast(1 AS double) END)
                    * (CASE stance_intensity WHEN 'weak' THEN cast(0.33 AS double)
                        WHEN 'moderate' THEN cast(0.66 AS double) ELSE cast(1.0 AS double) END)
                END AS stance_score
        FROM {m_labels}""",
    "m_contexts": """
        SELECT mention_id, document_id,
            CASE WHEN discount = 10 AND l_linenumber = 1 THEN '' ELSE
                concat('avant ', p_name, ' ', variant_normalized, ' apres') END AS context_window,
            5 AS context_word_count, l_linenumber AS context_start_char,
            l_linenumber + 40 AS context_end_char
        FROM {m_lines}""",
    "m_audit": """
        SELECT stance_audit_id, mention_id, document_id, figure_id, variant_id, stance_category_id,
            'model' AS stance_method, 'model-a' AS stance_model,
            'deterministic_label_intensity_mapping' AS stance_score_method,
            CASE WHEN discount > 5 THEN stance_score END AS model_stance_score_raw,
            CASE discount WHEN 0 THEN cast(NULL AS string) WHEN 1 THEN '  ' ELSE p_name END
                AS evidence_text,
            upper(p_name) AS evidence_translation_en, concat('about ', p_name) AS explanation,
            ship_date
        FROM {m_scored} WHERE is_scored""",
    "m_bridge_creators": """
        SELECT DISTINCT cast(l_orderkey AS string) AS document_id,
            <sha>lower(trim(s_name))</sha> AS creator_id,
            CASE l_linestatus WHEN 'O' THEN 'creator' ELSE 'author' END AS creator_source,
            l_linenumber AS creator_position
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
            JOIN {orders} ON l_orderkey = o_orderkey
        WHERE o_orderpriority <> '2-HIGH'""",
    "m_creators": """
        SELECT <sha>lower(trim(s_name))</sha> AS creator_id, min(s_name) AS creator_name
        FROM {supplier} WHERE s_acctbal >= 0 GROUP BY 1""",
    "m_bridge_subjects": """
        SELECT DISTINCT cast(o_orderkey AS string) AS document_id,
            <sha>lower(trim(c_mktsegment))</sha> AS subject_id,
            'metadata_subject' AS subject_source, 0 AS subject_position
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "m_subjects": """
        SELECT <sha>lower(trim(c_mktsegment))</sha> AS subject_id, min(c_mktsegment) AS subject
        FROM {customer} GROUP BY 1""",
    # ---- dates written into texts: one order gives a raw date, a title and a front matter ----
    "d_parts": """
        SELECT cast(o_orderkey AS string) AS document_id, o_custkey,
            cast(year(o_orderdate) AS int) - 206 AS y, cast(month(o_orderdate) AS int) AS m,
            cast(day(o_orderdate) AS int) AS d, o_orderpriority, o_orderstatus
        FROM {orders}""",
    "d_texts": """
        SELECT document_id,
            CASE o_custkey % 6 WHEN 0 THEN cast(y AS string)
                WHEN 1 THEN concat(cast(y AS string), '-', lpad(cast(m AS string), 2, '0'), '-',
                    cast(d AS string))
                WHEN 2 THEN concat(""" + pick(FRENCH, "m") + """, ', ', cast(y AS string))
                WHEN 3 THEN concat('[', cast(y AS string), '?]')
                WHEN 4 THEN '' END AS date_raw,
            CASE o_orderpriority
                WHEN '1-URGENT' THEN concat('Discours prononcé le ', cast(d AS string), ' ',
                    """ + pick(FRENCH, "m") + """, ' ', cast(y AS string))
                WHEN '2-HIGH' THEN concat('Rapport du ', cast(d AS string), ' ',
                    """ + pick(REPUBLICAN, "m") + """, ' an ', """ + pick(ROMAN, "y - 1787") + """)
                WHEN '3-MEDIUM' THEN concat('Rapport de ', """ + pick(REPUBLICAN, "m") + """,
                    ', an ', cast(y - 1787 AS string))
                WHEN '4-NOT SPECIFIED' THEN concat('ADRESSE du 31 ', upper(""" + pick(FRENCH, "m") + """),
                    '. ', cast(y AS string))
                ELSE 'Sans date claire' END AS title,
            CASE o_orderstatus
                WHEN 'F' THEN concat('Imprimé à Paris le 1er ', """ + pick(FRENCH, "m") + """, ' ',
                    cast(y AS string), ' avec permission.')
                WHEN 'O' THEN concat('A Lyon, ', cast(d AS string), ' ', """ + pick(REPUBLICAN, "m") + """,
                    ' an ', cast(y - 1787 AS string), ', chez l''auteur') END AS front_matter
        FROM {d_parts}""",
    # ---- text corpus: one document is a pamphlet with OCR text and metadata XML ----
    "t_texts": """
        SELECT cast(doc_id AS string) AS document_id, source,
            concat('ocr/', cast(doc_id AS string), '_djvu.txt') AS file_path,
            CASE source WHEN 'src3' THEN concat(text, ' Ã‚ ï¿½') WHEN 'src5' THEN ''
                WHEN 'src6' THEN concat(chr(32), chr(10), text, chr(9)) ELSE text END AS raw_text,
            'ocr_text' AS source_file_type
        FROM {documents}""",
    # Texts for left joins: one source has metadata alone.
    "t_ocr": """
        SELECT document_id, file_path, raw_text, source_file_type FROM {t_texts}
        WHERE source IS DISTINCT FROM 'src7'""",
    "t_parts": """
        SELECT cast(d.doc_id AS string) AS document_id, d.lang, d.source, l.quality, l.toxic,
            1789 + d.n_chars % 11 AS y, 1 + d.n_chars % 12 AS m, 1 + d.n_chars % 31 AS d
        FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "t_metadata": """
        SELECT document_id, concat('meta/', document_id, '_meta.xml') AS file_path,
            CASE source WHEN 'src8' THEN concat('<metadata><title>', lang, '</metadata>')
                WHEN 'src9' THEN '' ELSE concat('<metadata><title>  Adresse du ', cast(d AS string),
                ' ', """ + pick(FRENCH, "m") + """, '  ', cast(y AS string), ' </title>',
                CASE quality WHEN 1 THEN concat('<creator>Auteur  ', source, '</creator><creator> auteur ',
                    source, '</creator><creator>Auteur ', source, '</creator>') ELSE '' END,
                CASE toxic WHEN 0 THEN concat('<author>', upper(lang), '</author>') ELSE '' END,
                '<subject>', lang, '</subject>',
                CASE WHEN lang = 'fr' THEN '<subject> France </subject><subject>fr</subject>' ELSE '' END,
                '<date>', CASE source WHEN 'src1' THEN cast(y + 1 AS string) WHEN 'src2' THEN ' '
                    ELSE cast(y AS string) END, '</date><language>', lang, '</language><identifier>',
                CASE source WHEN 'src4' THEN 'other' ELSE document_id END,
                '</identifier><identifier-access>http://example.org/', document_id,
                '</identifier-access></metadata>') END AS raw_metadata_xml
        FROM {t_parts}""",
    # ---- lexicon: product lines are figures, product names are variants ----
    "l_rows": """
        SELECT DISTINCT p_type AS figure_id, concat('Figure ', p_type) AS canonical_name,
            concat(' ', upper(p_name), ' ') AS variant,
            CASE WHEN length(p_name) > 9 THEN replace(p_name, ' ', '  ') END AS variant_normalized,
            CASE WHEN length(p_name) > 9 THEN 'proper_name' ELSE 'title' END AS variant_type,
            CASE WHEN length(p_name) = 8 THEN 'medium' WHEN length(p_name) < 8 THEN 'low'
                ELSE 'high' END AS match_confidence,
            CASE WHEN p_type = 'PROMO' THEN ' ' ELSE 'listed' END AS notes
        FROM {part}""",
    "l_flawed": """
        SELECT p_type AS figure_id,
            CASE WHEN p_size = 1 THEN 'Someone' ELSE concat('Figure ', p_type) END AS canonical_name,
            CASE WHEN p_size = 2 THEN '' ELSE p_name END AS variant,
            CASE WHEN p_size = 3 THEN p_brand END AS variant_normalized, 'title' AS variant_type,
            CASE WHEN p_size = 4 THEN 'certain' WHEN p_size <> 5 THEN 'high' END AS match_confidence,
            cast(NULL AS string) AS notes
        FROM {part}""",
    # ---- words looked up in the texts ----
    "w_variants": """
        SELECT figure_id, <sha>concat_ws('|', figure_id, word)</sha> AS variant_id,
            upper(word) AS variant, word AS variant_normalized
        FROM (VALUES ('articles', 'the'), ('links', 'of'), ('links', 'and'), ('articles', 'der'),
            ('links', 'que'), ('articles', 'une'), ('others', 'elle'), ('links', 'of the'))
            AS v(figure_id, word)""",
    # ---- replies of a model: one event is a reply ----
    "r_replies": """
        SELECT cast(event_id AS string) AS mention_id, event_type, user_id,
            CASE WHEN user_id % 11 = 3 THEN concat('{{"stance_label": "positive", ', event_type)
                ELSE concat(CASE WHEN user_id % 7 = 0 THEN concat('```json', chr(10)) ELSE '' END,
                '{{"stance_label": "', CASE event_type WHEN 'click' THEN 'Positive'
                    WHEN 'error' THEN 'negative' WHEN 'view' THEN 'neutral_or_unclear'
                    WHEN 'purchase' THEN 'POSITIVE' ELSE 'hostile' END,
                '", "stance_intensity": "', CASE user_id % 5 WHEN 0 THEN 'weak' WHEN 1 THEN 'Moderate'
                    WHEN 2 THEN 'strong' WHEN 3 THEN 'none' ELSE 'fierce' END,
                '", "stance_confidence": "', CASE user_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium'
                    WHEN 2 THEN 'LOW' ELSE 'sure' END, '"',
                CASE user_id % 3 WHEN 0 THEN ', "target_relevance": "direct"'
                    WHEN 1 THEN ', "target_relevance": "indirect"' ELSE '' END,
                ', "stance_score": 0.5, "evidence_text": "', event_type, '"',
                ', "explanation": null}}',
                CASE WHEN user_id % 7 = 0 THEN concat(chr(10), '```') ELSE '' END) END AS raw_response
        FROM {events}""",
    "x_replies": """
        SELECT cast(event_id AS string) AS document_id,
            concat('Metadata date: ', props) AS extraction_input,
            CASE WHEN user_id % 13 = 5 THEN 'no json' ELSE concat('{{"response": {{',
                '"publication_year": {{"value": ', CASE WHEN user_id % 9 = 1 THEN 'null'
                    ELSE cast(1780 + user_id % 20 AS string) END, ', "confidence_score": 0.7}}, ',
                CASE WHEN user_id % 4 = 0 THEN concat('"publication_month": {{"value": "',
                    cast(1 + user_id % 12 AS string), '"}}, ') ELSE '' END,
                CASE user_id % 5 WHEN 0 THEN concat('"publication_date": {{"value": "1790-0',
                        cast(1 + user_id % 9 AS string), '-11", "confidence_score": 0.9}}, ')
                    WHEN 1 THEN '"publication_date": {{"value": "4 March 1791"}}, '
                    WHEN 2 THEN '"publication_date": {{"value": "1790-13-45"}}, ' ELSE '' END,
                '"date_precision": {{"value": "', CASE event_type WHEN 'click' THEN 'Day'
                    WHEN 'error' THEN 'month' ELSE 'exact' END, '"}}, "calendar": {{"value": "',
                CASE event_type WHEN 'click' THEN 'French republican' WHEN 'view' THEN 'Gregorian'
                    ELSE '' END, '"}}, "confidence": {{"value": ',
                CASE event_type WHEN 'purchase' THEN '"High"' WHEN 'view' THEN '"unsure"' ELSE 'null' END,
                '}}, "evidence": {{"value": ', CASE WHEN user_id % 9 = 1 THEN 'null' ELSE
                concat('"seen ', event_type, '"') END, ', "confidence_score": 0.',
                cast(user_id % 10 AS string), '}}}}}}') END AS extracted
        FROM {events}""",
    # ---- date candidates: rule and model candidates of every order ----
    "c_documents": """
        SELECT cast(o_orderkey AS string) AS document_id,
            CASE WHEN o_orderpriority <> '5-LOW' THEN concat('[', cast(year(o_orderdate) AS string), ']')
                END AS publication_date_raw,
            'metadata_date' AS date_source, 'high' AS date_confidence,
            cast(NULL AS string) AS date_parse_notes,
            CASE WHEN o_orderpriority = '5-LOW' THEN cast(NULL AS int)
                ELSE cast(year(o_orderdate) AS int) END AS publication_year,
            cast(NULL AS int) AS publication_month, cast(NULL AS int) AS publication_day,
            cast(NULL AS date) AS publication_date,
            CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE 'year' END AS date_precision,
            CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE 'gregorian' END AS date_calendar,
            o_orderdate, o_orderpriority, o_orderstatus, o_totalprice, o_custkey
        FROM {orders}""",
    "c_keyed": """
        SELECT *, """ + date_key_sql() + """ AS date_key FROM {c_documents}""",
    "c_fields": """
        SELECT *, 'title' AS part FROM {c_keyed} UNION ALL SELECT *, 'front' AS part FROM {c_keyed}
        UNION ALL SELECT *, 'other' AS part FROM {c_keyed} WHERE o_orderstatus = 'O'""",
    "c_candidates": """
        SELECT <sha>concat_ws('|', document_id, 'rule_based_selected', date_source)</sha>
                AS date_candidate_id, document_id,
            'rule_based_metadata_title_ocr' AS extractor_name, '1' AS extractor_version,
            date_source AS candidate_source_field, publication_year AS candidate_publication_year,
            publication_month AS candidate_publication_month,
            publication_day AS candidate_publication_day,
            publication_date AS candidate_publication_date,
            date_precision AS candidate_date_precision, date_calendar AS candidate_date_calendar,
            date_confidence AS candidate_confidence,
            cast(NULL AS double) AS candidate_confidence_score,
            cast(NULL AS string) AS candidate_evidence, cast(NULL AS string) AS raw_extraction,
            'excerpt' AS source_text_excerpt, true AS selected_for_document
        FROM {c_keyed}
        UNION ALL
        SELECT <sha>concat_ws('|', document_id, 'model_extract', part)</sha>, document_id,
            CASE part WHEN 'other' THEN 'by_hand' ELSE 'model_extract' END, '2.1',
            concat('field_', part),
            CASE WHEN o_custkey % 4 = 1 THEN cast(year(o_orderdate) AS int) + 1
                ELSE cast(year(o_orderdate) AS int) END,
            CASE WHEN o_orderstatus <> 'P' THEN cast(month(o_orderdate) AS int) END,
            CASE WHEN o_orderstatus = 'F' THEN cast(day(o_orderdate) AS int) END,
            CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS date) END,
            CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown'
                WHEN o_orderstatus = 'F' THEN 'day' WHEN o_orderstatus = 'O' THEN 'month'
                ELSE 'year' END,
            'gregorian', CASE WHEN o_custkey % 3 = 0 THEN 'high' WHEN o_custkey % 3 = 1 THEN 'medium'
                ELSE 'low' END,
            CASE part WHEN 'title' THEN cast(0.9 AS double) ELSE cast(0.7 AS double) END,
            concat('seen in ', part), '{{}}', 'excerpt', false
        FROM {c_fields}""",
}

# Joins that a definition reads and that may be given, already made, under a name of their own.
JOINS = {
    "line_parts": ("m_lines", "{lineitem} JOIN {part} ON l_partkey = p_partkey"),
    "line_suppliers": (
        "m_bridge_creators",
        """{lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
            JOIN {orders} ON l_orderkey = o_orderkey""",
    ),
}

_SHA = re.compile(r"<sha>(.*?)</sha>", re.S)


def _names_in(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"(?<!\{)\{([a-z_]+)\}", text)))


# Where derived tables are kept between queries, by data folder; empty means nowhere.
STAGED: dict[str, str] = {}


def stage(spark: SparkSession, folder: str, target: str) -> None:
    """Write every derived table once, so that later queries read instead of derive."""
    tables = Fixtures(spark, folder)
    for name in DEFINITIONS:
        getattr(tables, name).write.parquet(f"{target}/{name}")
    STAGED[folder] = target


class Fixtures:
    """The derived tables as DataFrames over one data folder; those that are given are taken as they are."""

    def __init__(self, spark: SparkSession, folder: str, given: dict[str, DataFrame] | None = None):
        self.spark, self.folder, self._built = spark, folder, dict(given or {})

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in DEFINITIONS and self.folder in STAGED:
                frame = self.spark.read.parquet(f"{STAGED[self.folder]}/{name}")
            elif name in GIVEN:
                frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
                if name in COSTLY:
                    frame = spread(frame)
            else:
                text = DEFINITIONS[name]
                for made, (reader, join) in JOINS.items():
                    if reader == name and made in self._built:
                        text = text.replace(join, f"{{{made}}}")
                text = _SHA.sub(r"sha2(\1, 256)", text)
                needed = {n: getattr(self, n) for n in _names_in(text)}
                frame = self.spark.sql(text, **needed)
            self._built[name] = frame
        return self._built[name]


def with_tables(query: str, extra: dict[str, str] | None = None) -> str:
    """DuckDB text of a query: every ``{name}`` it uses becomes a common table expression.

    ``extra`` holds further definitions that only exist on the DuckDB side; in them
    and in the query braces need no doubling.
    """
    extra = extra or {}
    known = [*GIVEN, *DEFINITIONS, *extra]
    reference = re.compile(r"\{(" + "|".join(known) + r")\}")
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name in GIVEN or name in ordered:
            return
        text = extra.get(name) or DEFINITIONS[name]
        for other in dict.fromkeys(reference.findall(text)):
            add(other)
        text = reference.sub(r"\1", _SHA.sub(r"sha256(\1)", text))
        if name not in extra:
            text = text.replace("{{", "{").replace("}}", "}")
        ordered[name] = text

    for name in dict.fromkeys(reference.findall(query)):
        add(name)
    body = reference.sub(r"\1", _SHA.sub(r"sha256(\1)", query))
    tables = ",\n".join(f"{name} AS ({text})" for name, text in ordered.items())
    return f"WITH {tables}\n{body}" if tables else body
