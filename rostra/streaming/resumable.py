"""Resumable scoring: select a batch, score it once, append what the model said.

The audit decides. A mention counts as scored when the audit has a row of it, and its
stance columns are those of its latest row, whatever run wrote it: a run that broke off
between two writes leaves nothing to repair. A batch costs what it adds, not what the
tables hold; the mention table itself is only rewritten when it is published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.operators.ranking import first_per_group
from rostra.plans import stance
from rostra.sources.tables import Tables, materialize, with_missing_columns


def ensure_stance_tables(tables: Tables) -> None:
    """Empty category and audit tables, and stance columns on the mention facts."""
    tables.create_if_missing("silver_dim_stance_categories", stance.CATEGORY_SCHEMA)
    tables.create_if_missing("silver_stance_model_audit", stance.AUDIT_SCHEMA)
    mentions = tables.read("silver_fact_figure_mentions")
    extended = with_missing_columns(mentions, stance.MENTION_STANCE_COLUMNS)
    if extended.columns != mentions.columns:
        tables.write("silver_fact_figure_mentions", extended)


def score_next_batch(
    tables: Tables, scorer: Callable[[list[str]], list[str]], model: str, **selection
) -> int:
    """Score up to ``limit`` mentions and append the results; returns how many.

    The scored batch is written before anything is appended, so the model answers once
    per mention. Categories come before the audit rows that name them. A run that fails
    is simply repeated: mentions already audited are not selected again, a category that
    is there is not added again, and of several audit rows of a mention the last counts.
    """
    ensure_stance_tables(tables)
    mentions = tables.read("silver_fact_figure_mentions")
    contexts = tables.read("silver_dim_mention_contexts")
    documents = tables.read("silver_dim_documents")
    audit = tables.read("silver_stance_model_audit")
    batch = stance.select_batch(mentions, contexts, audit, model, **selection)
    prompts = stance.with_prompts(batch, contexts, documents)
    replies = stance.score_prompts(prompts, scorer)
    scored = materialize(
        stance.score_replies(stance.normalize_replies(replies), model).withColumn(
            "stance_scored_at", F.current_timestamp()
        )
    )
    size = scored.count()
    if size:
        known = tables.read("silver_dim_stance_categories")
        found = stance.merge_categories(known.limit(0), scored)
        tables.append(
            "silver_dim_stance_categories",
            found.join(known.select("stance_category_id"), "stance_category_id", "left_anti"),
        )
        empty = tables.read("silver_stance_model_audit").limit(0)
        tables.append("silver_stance_model_audit", stance.merge_audit(empty, scored))
    return size


def current_audit(tables: Tables) -> DataFrame:
    """The audit with the last answer of each mention and model."""
    return first_per_group(
        tables.read("silver_stance_model_audit"), ["stance_audit_id"], [F.desc("stance_scored_at")]
    )


def scored_mentions(tables: Tables) -> DataFrame:
    """The mention facts with the stance of their latest audit row."""
    return stance.update_mentions(
        tables.read("silver_fact_figure_mentions"),
        current_audit(tables),
        tables.read("silver_dim_stance_categories"),
    )


def publish_mentions(tables: Tables) -> DataFrame:
    """Write the mention facts with all stances found so far as a new version."""
    return tables.write("silver_fact_figure_mentions", scored_mentions(tables))
