"""One corpus through all stages: raw texts and metadata to stance over time.

Every stage reads what the one before stored, and every table is measured while it is
written. A stage can be run again by itself: it replaces its tables by new versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.operators.contexts import WORDS_AFTER, WORDS_BEFORE
from rostra.operators.mentions import find_mentions
from rostra.plans import dates, documents, figures, gold, mentions, stance, texts
from rostra.plans.incremental import Star
from rostra.plans.quality import MeasuredTables
from rostra.sources.tables import materialize, released, with_missing_columns
from rostra.streaming import resumable

Model = Callable[[list[str]], list[str]]


def build_documents(
    tables: MeasuredTables,
    metadata: DataFrame,
    ocr: DataFrame,
    extractor: Model | None = None,
    front_matter: int | None = None,
) -> None:
    """Bronze tables, document model, texts, date candidates and the selected dates.

    With an ``extractor`` its candidates compete with those of the rules. Documents, dates
    and facts are written once, with the selected dates.
    """
    write = tables.write
    with released(metadata.sparkSession):
        stored = write("bronze_metadata", metadata)
        raw = write("bronze_ocr_text", ocr)
        parsed = materialize(documents.parsed_documents(stored, raw, front_matter))
        clean = materialize(texts.clean_document_text(raw))
        write("silver_dim_document_text", texts.dim_document_text(clean))
        creators, subjects = documents.creator_entries(parsed), documents.subject_entries(parsed)
        write("silver_dim_creators", documents.dim_creators(creators))
        write("silver_bridge_document_creators", documents.bridge_creators(creators))
        write("silver_dim_subjects", documents.dim_subjects(subjects))
        write("silver_bridge_document_subjects", documents.bridge_subjects(subjects))

        candidates = documents.rule_date_candidates(parsed)
        if extractor is not None:
            # A model may answer differently when it is asked again.
            replies = materialize(dates.extract_with_model(parsed, extractor))
            candidates = dates.candidates_with_model(candidates, dates.model_date_candidates(replies))
        candidates = materialize(candidates)
        selected = materialize(dates.select_dates(candidates, parsed))
        write("silver_publication_date_candidates", dates.mark_candidates(candidates, selected))
        docs = write(
            "silver_dim_documents", dates.documents_with_selected_date(documents.dim_documents(parsed), selected)
        )
        write("silver_dim_dates", dates.dates_after_selection(selected, docs, documents.dim_dates(parsed)))
        facts = texts.fact_documents_with_text(documents.fact_documents(parsed), clean)
        write("silver_fact_documents", dates.facts_after_selection(facts, selected))


def build_mentions(
    tables: MeasuredTables, lexicon: DataFrame, before: int = WORDS_BEFORE, after: int = WORDS_AFTER
) -> None:
    """Figures, variants, mention facts and contexts, which come from one walk over the texts."""
    read = tables.tables.read
    with released(lexicon.sparkSession):
        people = tables.write("silver_dim_figures", figures.dim_figures(lexicon))
        variants = tables.write("silver_dim_figure_variants", figures.dim_variants(lexicon))
        found = materialize(find_mentions(read("silver_dim_document_text"), variants, contexts=(before, after)))
        facts = mentions.fact_mentions(
            found, read("silver_dim_documents"), read("silver_dim_dates"), read("silver_fact_documents"), people, variants
        )
        # Not scored yet: the stance columns are there, and empty.
        tables.write("silver_fact_figure_mentions", with_missing_columns(facts, stance.MENTION_STANCE_COLUMNS))
        columns = [c for c in found.columns if c.startswith(("context_", "words_"))]
        tables.write("silver_dim_mention_contexts", found.select("mention_id", "document_id", *columns))


def score_mentions(tables: MeasuredTables, scorer: Model, model: str, limit: int | None = None, **selection) -> int:
    """Score all mentions that are ready, ``limit`` at a time, and publish them; returns how many.

    Ends when a batch is empty. Audit and categories, to which batches append, are
    rewritten as one version each.
    """
    plain, scored = tables.tables, 0
    while size := resumable.score_next_batch(plain, scorer, model, limit=limit, **selection):
        scored += size
        if limit is None:
            break
    resumable.ensure_stance_tables(plain)
    tables.write("silver_stance_model_audit", resumable.current_audit(plain))
    tables.write("silver_dim_stance_categories", plain.read("silver_dim_stance_categories"))
    tables.write("silver_fact_figure_mentions", resumable.scored_mentions(plain))
    return scored


def star(tables: MeasuredTables) -> Star:
    """The stored tables that gold is aggregated from."""
    read = tables.tables.read
    return Star(
        mentions=read("silver_fact_figure_mentions"),
        documents=read("silver_dim_documents"),
        dates=read("silver_dim_dates"),
        categories=read("silver_dim_stance_categories"),
        contexts=read("silver_dim_mention_contexts"),
        audit=read("silver_stance_model_audit"),
        creator_bridge=read("silver_bridge_document_creators"),
        creators=read("silver_dim_creators"),
        subject_bridge=read("silver_bridge_document_subjects"),
        subjects=read("silver_dim_subjects"),
    )


def build_gold(tables: MeasuredTables) -> None:
    write, s = tables.write, star(tables)
    write("gold_figure_mentions_by_period", gold.figure_mentions_by_period(s.mentions, s.dates, s.categories))
    write("gold_figure_stance_by_period", gold.figure_stance_by_period(s.mentions, s.dates, s.categories))
    by_document = write(
        "gold_figure_stance_by_document",
        gold.figure_stance_by_document(s.mentions, s.documents, s.dates, s.categories),
    )
    write(
        "gold_top_stance_contexts",
        gold.top_stance_contexts(s.mentions, s.documents, s.dates, s.contexts, s.categories, s.audit),
    )
    write(
        "gold_figure_stance_by_creator_period",
        gold.figure_stance_by_creator(by_document, s.creator_bridge, s.creators),
    )
    write(
        "gold_figure_stance_by_subject_period",
        gold.figure_stance_by_subject(by_document, s.subject_bridge, s.subjects),
    )


def run(
    tables: MeasuredTables,
    metadata: DataFrame,
    ocr: DataFrame,
    lexicon: DataFrame,
    scorer: Model,
    model: str,
    extractor: Model | None = None,
    **selection,
) -> DataFrame:
    """All stages in order; returns the quality metrics of the corpus, which are stored as well."""
    build_documents(tables, metadata, ocr, extractor)
    build_mentions(tables, lexicon)
    score_mentions(tables, scorer, model, **selection)
    build_gold(tables)
    return tables.store()
