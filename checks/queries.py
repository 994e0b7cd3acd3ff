"""One query per operator, over the tables derived in ``fixtures``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixtures import STAGED, Fixtures
from rostra.functions import stance as st
from rostra.functions.dates import best_publication_date, date_from_text
from rostra.operators import joins, upserts
from rostra.operators.contexts import mention_contexts
from rostra.operators.mentions import find_mentions
from rostra.plans import dates, documents, figures, gold, incremental, mentions, quality, replies, stance, texts
from rostra.sources import files, lexicon, manifest, ordered
from rostra.sources.parts import PartedTable
from rostra.sources.tables import (
    Tables, checkpoint_folder, materialize, with_missing_columns, write_colocated,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    """Register ``build`` under its name. Dates are shown as text and averages rounded,
    because engines differ in how they hand over the one and sum up the other."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = build(Fixtures(spark, folder))
        changes = {}
        for field in result.schema.fields:
            if isinstance(field.dataType, T.DateType):
                changes[field.name] = F.col(field.name).cast("string")
            elif isinstance(field.dataType, T.DoubleType) and field.name.startswith("avg_"):
                changes[field.name] = F.round(field.name, 9)
        return result.withColumns(changes) if changes else result

    QUERIES[build.__name__] = run
    return build


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _write_files(rows: DataFrame, text: str, folder: str, suffix: str) -> None:
    """One file per document, written by the tasks into the shared folder."""

    def write(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(base)
        for batch in batches:
            for name, content in zip(batch["document_id"], batch[text]):
                with store.open_output_stream(f"{base}/{name}{suffix}") as out:
                    out.write((content or "").encode("utf-8"))
            yield batch[["document_id"]]

    rows.select("document_id", text).mapInPandas(write, "document_id string").count()


# ---- sources and sinks ----


@query
def scan_metadata_files(fx):
    folder = _scratch(fx.spark, "metadata")
    _write_files(fx.t_metadata, "raw_metadata_xml", folder, files.METADATA_SUFFIX)
    return files.read_metadata_files(fx.spark, folder).select("document_id", "raw_metadata_xml")


@query
def scan_ocr_files(fx):
    folder = _scratch(fx.spark, "ocr")
    _write_files(fx.t_texts, "raw_text", folder, files.OCR_SUFFIX)
    scanned = files.read_ocr_text_files(fx.spark, folder)
    return scanned.select("document_id", "raw_text", "source_file_type")


@query
def lexicon_scan(fx):
    folder = _scratch(fx.spark, "lexicon")
    fx.l_rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(folder)
    return lexicon.read_lexicon_csv(fx.spark, folder)


@query
def write_nonempty(fx):
    """Two versions of one table, the second rewritten from the first."""
    tables = Tables(fx.spark, _scratch(fx.spark, "tables"))
    first = tables.write("silver_dim_dates", fx.m_dates)
    return tables.write("silver_dim_dates", first.where("has_publication_year"))


@query
def write_ordered(fx):
    """Mentions in a global order, later years first; each row with its place, file after file."""
    columns = ["publication_year", "figure_id", "mention_id"]
    path = _scratch(fx.spark, "ordered")
    ordered.write_ordered(fx.m_mentions.select(*columns), path, "-publication_year", "figure_id", "mention_id")
    stored = ordered.read_ordered(fx.spark, path)
    # The rows of earlier files, then the place in the own one.
    files_ = stored.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = files_.alias("f").join(files_.alias("o"), F.col("o.file") < F.col("f.file"), "left").groupBy("f.file").agg(
        F.coalesce(F.sum("o.n"), F.lit(0)).alias("before")
    )
    return stored.join(before, "file").select(*columns, (F.col("before") + F.col("place") + 1).alias("place"))


@query
def corpus_by_manifest(fx):
    ids = manifest.manifest_ids(fx.labels, "doc_id")
    return manifest.restrict_to_manifest(fx.t_ocr.select("document_id", "file_path"), ids)


@query
def evolve_schema(fx):
    plain = fx.m_mentions.select("mention_id", "document_id", "stance_score")
    return with_missing_columns(
        plain, {k: v for k, v in stance.MENTION_STANCE_COLUMNS.items() if v != "timestamp"}
    )


# ---- metadata, dates from text, dimensional model ----


@query
def metadata_parse(fx):
    parsed = documents.parse_metadata(fx.t_metadata).drop("metadata_parse_error")
    return parsed.withColumns(
        {
            name: F.array_join(name, "; ")
            for name in ("creators", "metadata_authors", "subjects")
        }
    )


@query
def date_from_text_(fx):
    written = fx.d_texts.select(
        "document_id",
        date_from_text("title", "title", "medium").alias("date"),
    )
    return written.select("document_id", "date.*")


QUERIES["date_from_text"] = QUERIES.pop("date_from_text_")


@query
def date_best_of_sources(fx):
    best = best_publication_date("date_raw", "title", "front_matter")
    return fx.d_texts.select("document_id", best.alias("date")).select("document_id", "date.*")


def _parsed(fx) -> DataFrame:
    return documents.parsed_documents(fx.t_metadata, fx.t_ocr, front_matter=2000)


PARSED_COLUMNS = [
    "document_id",
    "metadata_document_id",
    "document_id_matches_metadata",
    "title",
    "creator",
    "author",
    "publication_date_raw",
    "has_ocr_text",
    "publication_year",
    "publication_month",
    "publication_day",
    "publication_date",
    "date_precision",
    "date_source",
    "date_calendar",
    "date_confidence",
    "date_key",
    "metadata_parse_status",
]


@query
def parsed_documents(fx):
    return _parsed(fx).select(*PARSED_COLUMNS)


@query
def dim_dates(fx):
    return documents.dim_dates(_parsed(fx))


@query
def dim_creators(fx):
    return documents.dim_creators(documents.creator_entries(_parsed(fx)))


@query
def bridge_creators(fx):
    return documents.bridge_creators(documents.creator_entries(_parsed(fx)))


@query
def dim_subjects(fx):
    return documents.dim_subjects(documents.subject_entries(_parsed(fx)))


@query
def bridge_subjects(fx):
    return documents.bridge_subjects(documents.subject_entries(_parsed(fx)))


@query
def date_candidates_rule(fx):
    return documents.rule_date_candidates(_parsed(fx), excerpt_characters=2500).drop("raw_extraction")


@query
def fact_documents(fx):
    return documents.fact_documents(_parsed(fx))


# ---- texts ----


@query
def text_clean(fx):
    return texts.clean_document_text(fx.t_texts).drop("raw_text", "source")


@query
def fact_documents_text(fx):
    clean = texts.clean_document_text(fx.t_ocr)
    return texts.fact_documents_with_text(documents.fact_documents(_parsed(fx)), clean)


@query
def text_quality_summary(fx):
    return texts.text_quality_summary(texts.clean_document_text(fx.t_texts))


# ---- date candidates and selection ----


@query
def date_candidates_model(fx):
    return dates.model_date_candidates(fx.x_replies, excerpt_characters=2500).drop("raw_extraction")


@query
def candidates_replace_by_source(fx):
    model = dates.model_date_candidates(fx.x_replies)
    combined = dates.candidates_with_model(fx.c_candidates, model)
    return combined.drop("raw_extraction", "source_text_excerpt")


def _selected(fx) -> DataFrame:
    return dates.select_dates(fx.c_candidates, fx.c_keyed)


@query
def select_dates(fx):
    return _selected(fx)


@query
def candidates_marked(fx):
    marked = dates.mark_candidates(fx.c_candidates, _selected(fx))
    return marked.select("date_candidate_id", "document_id", "selected_for_document")


CANDIDATE_DOCUMENT = [
    "document_id",
    "date_key",
    "publication_date_raw",
    "date_source",
    "date_confidence",
    "date_parse_notes",
]


@query
def documents_with_selected_date(fx):
    return dates.documents_with_selected_date(
        fx.c_keyed.select(*CANDIDATE_DOCUMENT), _selected(fx)
    )


@query
def dates_after_selection(fx):
    selected = _selected(fx)
    after = dates.documents_with_selected_date(fx.c_keyed.select(*CANDIDATE_DOCUMENT), selected)
    return dates.dates_after_selection(selected, after, documents.dim_dates(fx.c_keyed))


def _facts_after_selection(fx):
    facts = fx.c_keyed.select(
        "document_id",
        "date_key",
        (F.col("o_orderstatus") != "P").alias("has_ocr_text"),
        F.when(F.col("o_totalprice") < 100000, "empty_text").otherwise("usable").alias(
            "ocr_quality_flag"
        ),
    )
    return dates.facts_after_selection(facts, _selected(fx))


@query
def facts_after_selection(fx):
    return _facts_after_selection(fx)


@query
def mentions_after_selection(fx):
    moved = dates.mentions_after_selection(fx.m_mentions, _selected(fx), _facts_after_selection(fx))
    return moved.select(
        "mention_id",
        "document_id",
        "date_key",
        *documents.DATE_COLUMNS,
        "included_in_analysis_flag",
        "is_analysis_ready",
        "is_stance_ready",
    )


# ---- lexicon ----


@query
def lexicon_validate(fx):
    return lexicon.lexicon_violations(
        lexicon.normalize_lexicon(lexicon.clean_lexicon(fx.l_flawed))
    )


def _lexicon(fx) -> DataFrame:
    return lexicon.normalize_lexicon(lexicon.clean_lexicon(fx.l_rows))


@query
def dim_figures(fx):
    return figures.dim_figures(_lexicon(fx))


@query
def dim_figures_stamped(fx):
    """Figures from a lexicon with load stamps: the earliest of their rows."""
    stamp = F.to_timestamp(F.concat(F.lit("1790-01-"), F.lpad(F.length("variant").cast("string"), 2, "0")))
    lexicon_rows = lexicon.normalize_lexicon(lexicon.clean_lexicon(fx.l_rows.withColumn(lexicon.STAMP, stamp)))
    return figures.dim_figures(lexicon_rows).withColumn(lexicon.STAMP, F.date_format(lexicon.STAMP, "yyyy-MM-dd"))


@query
def dim_variants(fx):
    return figures.dim_variants(_lexicon(fx))


# ---- mentions and contexts ----


def _texts(fx) -> DataFrame:
    raw = fx.documents.select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.col("text").alias("raw_text"),
        F.lit("p").alias("file_path"),
        F.lit("ocr_text").alias("source_file_type"),
    )
    return texts.clean_document_text(raw)


@query
def mentions_extract(fx):
    return find_mentions(_texts(fx), fx.w_variants)


@query
def mentions_extract_routed(fx):
    """The way of a very large lexicon: variants are dealt to slices, each with a walk of its own."""
    return find_mentions(_texts(fx), fx.w_variants, slice_bytes=1200)


@query
def mention_contexts_(fx):
    found = find_mentions(_texts(fx), fx.w_variants, contexts=(75, 75))
    return found.select(
        "mention_id",
        "words_before_actual",
        "words_after_actual",
        "context_word_count",
        "context_start_char",
        "context_end_char",
        "context_window",
    )


QUERIES["mention_contexts"] = QUERIES.pop("mention_contexts_")


@query
def mention_contexts_joined(fx):
    """Contexts for a stored mention table, cut from the joined text."""
    corpus = _texts(fx)
    found = find_mentions(corpus, fx.w_variants)
    return mention_contexts(found, corpus, 5, 5).drop(
        "file_path", "words_before_requested", "words_after_requested"
    )


@query
def mention_contexts_colocated(fx):
    """Contexts of stored mentions: texts and mentions lie in the same buckets and are not moved."""
    corpus = _texts(fx)
    tables = []
    placed = corpus.select("document_id", "clean_text", "file_path")
    for kind, rows in (("texts", placed), ("mentions", find_mentions(corpus, fx.w_variants))):
        name = f"{kind}_{uuid.uuid4().hex}"
        tables.append(write_colocated(rows, name, _scratch(fx.spark, name), "document_id", buckets=16))
        # The rows stay readable; the catalog does not grow with every call.
        fx.spark.sql(f"DROP TABLE {name}")
    stored, found = tables
    return mention_contexts(found, stored.hint("merge"), 5, 5).drop(
        "file_path", "words_before_requested", "words_after_requested"
    )


@query
def fact_mentions(fx):
    # Parsed once and stored, as the stage before this one would leave it.
    parsed = materialize(_parsed(fx))
    clean = texts.clean_document_text(fx.t_ocr)
    lexicon_rows = fx.w_variants.select(
        "variant_id",
        "figure_id",
        F.lit("title").alias("variant_type"),
        F.when(F.col("figure_id") == "links", "high").otherwise("low").alias("match_confidence"),
    )
    names = fx.w_variants.select("figure_id", F.upper("figure_id").alias("canonical_name"))
    return mentions.fact_mentions(
        find_mentions(clean, fx.w_variants),
        documents.dim_documents(parsed),
        documents.dim_dates(parsed),
        texts.fact_documents_with_text(documents.fact_documents(parsed), clean),
        names.distinct(),
        lexicon_rows,
    )


# ---- stance ----


def _batch(fx, **selection) -> DataFrame:
    scored = fx.m_audit.where(F.col("model_stance_score_raw").isNotNull())
    return stance.select_batch(fx.m_mentions, fx.m_contexts, scored, "model-a", **selection)


@query
def stance_batch_select(fx):
    """The 1000 oldest mentions still to be scored: the limit is the feature."""
    return _batch(fx, limit=1000, match_confidence="any").select("mention_id", "document_id", "figure_id")


@query
def stance_prompt(fx):
    """Prompts of all mentions that are to be scored."""
    batch = _batch(fx, limit=None, match_confidence="any")
    prompts = stance.with_prompts(batch, fx.m_contexts, fx.m_documents, "Classify.")
    return prompts.select("mention_id", "prompt")


@query
def stance_normalize(fx):
    return stance.normalize_replies(fx.r_replies).drop("event_type", "user_id", "raw_response")


@query
def stance_score(fx):
    scored = stance.score_replies(stance.normalize_replies(fx.r_replies), "model-a")
    return scored.select(
        "mention_id", "stance_audit_id", "stance_category_id", "stance_score", "stance_score_method"
    )


@query
def model_score_column(fx):
    """A stand-in for a model: answers in JSON from the prompt alone."""

    def scorer(prompts):
        labels = ["positive" if len(prompt) % 2 else "negative" for prompt in prompts]
        return [f'{{"stance_label": "{la}", "stance_intensity": "weak"}}' for la in labels]

    prompts = fx.m_contexts.select("mention_id", F.col("context_window").alias("prompt"))
    replies = stance.normalize_replies(stance.score_prompts(prompts, scorer))
    return replies.select("mention_id", "stance_label", "stance_intensity")


@query
def model_reply_cache(fx):
    """Replies to prompts that many mentions share; the scorer fails on some of them."""

    def scorer(prompts):
        if any("rod" in prompt for prompt in prompts):
            raise RuntimeError("refused")
        return [f'{{"stance_label": "{"positive" if len(prompt) % 2 else "negative"}"}}' for prompt in prompts]

    names = fx.part.select("p_partkey", F.col("p_name").alias("prompt"))
    tables = Tables(fx.spark, _scratch(fx.spark, "replies"))
    return replies.ask(names, scorer, tables, "model-a").select("p_partkey", "raw_response", "error")


@query
def model_extract_column(fx):
    def extractor(inputs):
        return [f'{{"response": {{"publication_year": {{"value": {len(i)}}}}}}}' for i in inputs]

    asked = fx.d_texts.withColumnsRenamed(
        {"date_raw": "publication_date_raw", "front_matter": "ocr_front_matter"}
    )
    replies = dates.extract_with_model(asked, extractor)
    return dates.model_date_candidates(replies).select(
        "document_id", "candidate_publication_year", "candidate_date_precision"
    )


# ---- upserts ----


@query
def merge_insert_only(fx):
    known = fx.m_categories.where("stance_confidence = 'high'")
    return upserts.merge_insert_only(known, fx.m_categories, "stance_category_id")


def _audit_sources(fx) -> tuple[DataFrame, DataFrame]:
    """Stored audit rows, and those of a later run."""
    columns = ["stance_audit_id", "mention_id", "evidence_text", "explanation"]
    old = fx.m_audit.where("model_stance_score_raw IS NOT NULL").select(*columns)
    rescored = fx.m_audit.where("evidence_text IS NULL OR model_stance_score_raw > 0")
    return old, rescored.select(*columns).withColumn("explanation", F.lit("again"))


@query
def merge_upsert(fx):
    old, rescored = _audit_sources(fx)
    return upserts.merge_upsert(old, rescored, "stance_audit_id")


@query
def merge_upsert_parts(fx):
    """The same into a stored table: only parts that have a key of the batch are written."""
    old, rescored = _audit_sources(fx)
    table = PartedTable(fx.spark, _scratch(fx.spark, "audit"), old.schema, ["stance_audit_id"])
    table.write(old)
    table.upsert(rescored)
    return table.read()


def _audit_with_later_rows(fx) -> DataFrame:
    """Audit rows, and a later one for each without evidence; both come from one scan."""
    runs = F.array(F.lit(False), F.lit(True))
    later = F.col("later")
    rows = fx.m_audit.withColumn("later", F.explode(F.when(F.isnull("evidence_text"), runs).otherwise(F.slice(runs, 1, 1))))
    again = {
        "stance_audit_id": F.concat("stance_audit_id", F.lit("-b")),
        "stance_category_id": F.lit("gone"),
        "ship_date": F.date_add("ship_date", 1),
    }
    rows = rows.withColumns({name: F.when(later, value).otherwise(F.col(name)) for name, value in again.items()})
    return rows.drop("later").withColumnRenamed("ship_date", "stance_scored_at")


STANCE_OF_MENTIONS = ["mention_id", "document_id", *stance.MENTION_STANCE_COLUMNS]


@query
def merge_update_latest(fx):
    fx = small_once(fx, "m_categories")
    return stance.update_mentions(
        _mentions_dealt(fx).withColumn("stance_updated_at", F.lit(None).cast("date")),
        _audit_with_later_rows(fx),
        fx.m_categories,
    ).select(*STANCE_OF_MENTIONS)


@query
def merge_update_latest_parts(fx):
    """The same in a stored mention table: only parts that have a mention of the audit are written."""
    fx = small_once(fx, "m_categories")
    mentions_ = _mentions_dealt(fx).withColumn("stance_updated_at", F.lit(None).cast("date"))
    table = PartedTable(fx.spark, _scratch(fx.spark, "mentions"), mentions_.schema, ["mention_id"])
    table.write(mentions_)
    stance.update_mention_table(table, _audit_with_later_rows(fx), fx.m_categories)
    return table.read().select(*STANCE_OF_MENTIONS)


# ---- joins ----


@query
def join_star_left(fx):
    fx = small_once(fx, "m_dates", "m_categories")
    return joins.join_star_left(
        fx.m_mentions.select("mention_id", "document_id", "date_key", "stance_category_id"),
        (fx.m_documents.select("document_id", "title"), "document_id"),
        (fx.m_dates.select("date_key", "period_label"), "date_key"),
        (fx.m_categories.select("stance_category_id", "stance_label"), "stance_category_id"),
    )


@query
def join_anti_resumable(fx):
    todo = fx.m_mentions.select("mention_id", "figure_id")
    return joins.join_anti_resumable(
        todo, fx.m_audit.where("evidence_text IS NOT NULL"), "mention_id"
    )


@query
def join_null_safe(fx):
    keys = ["publication_year", "publication_month"]
    lines = fx.m_mentions.groupBy(*keys).agg(F.count(F.lit(1)).alias("mentions"))
    orders = fx.m_documents.groupBy(*keys).agg(F.count(F.lit(1)).alias("documents"))
    return joins.join_null_safe(lines, orders, keys)


@query
def join_bridge_expand(fx):
    return joins.join_bridge_expand(
        fx.m_documents.select("document_id", "title"),
        fx.m_bridge_creators,
        ["creator_id", "creator_source"],
    )


# ---- gold ----


def small_once(fx, *names: str) -> Fixtures:
    """Small tables stored, as the stages before leave them: the rows that they are joined with stay where they
    are, as Spark knows the size of what is stored, and not that of a table still to be derived."""
    if fx.folder in STAGED:
        return fx
    return Fixtures(fx.spark, fx.folder, {name: materialize(getattr(fx, name)) for name in names})


def lines_by_document(fx) -> Fixtures:
    """Lines and documents stored in buckets by document, and the small tables that they are joined with. Mentions,
    contexts and audit rows are what a task makes of the lines of its documents: their digests are neither shuffled
    nor stored."""
    if fx.folder in STAGED:
        return fx
    documents_ = _by_document_id(fx, "documents", fx.m_documents)
    lines = _by_document_id(fx, "lines", _lines_dealt(fx).m_lines, placed=True)
    given = {"m_documents": documents_, "m_lines": lines}
    small = small_once(Fixtures(fx.spark, fx.folder, given), "m_dates", "m_categories")
    return Fixtures(fx.spark, fx.folder, {**given, "m_dates": small.m_dates, "m_categories": small.m_categories})


@query
def gold_mentions_by_period(fx):
    fx = small_once(fx, "m_dates", "m_categories")
    return gold.figure_mentions_by_period(fx.m_mentions, fx.m_dates, fx.m_categories)


@query
def gold_stance_by_period(fx):
    fx = small_once(fx, "m_dates", "m_categories")
    return gold.figure_stance_by_period(fx.m_mentions, fx.m_dates, fx.m_categories)


@query
def gold_stance_by_period_plain_keys(fx):
    fx = small_once(fx, "m_dates", "m_categories")
    return gold.figure_stance_by_period(
        fx.m_mentions, fx.m_dates, fx.m_categories, null_safe_keys=False
    )


def _by_document(fx) -> DataFrame:
    return gold.figure_stance_by_document(
        fx.m_mentions, fx.m_documents, fx.m_dates, fx.m_categories
    )


@query
def gold_stance_by_document(fx):
    fx = small_once(fx, "m_dates", "m_categories")
    return _by_document(fx)


@query
def gold_stance_by_creator(fx):
    fx = small_once(fx, "m_dates", "m_categories")
    return gold.figure_stance_by_creator(_by_document(fx), fx.m_bridge_creators, fx.m_creators)


@query
def gold_stance_by_subject(fx):
    fx = small_once(fx, "m_dates", "m_categories")
    return gold.figure_stance_by_subject(_by_document(fx), fx.m_bridge_subjects, fx.m_subjects)


@query
def gold_top_contexts(fx):
    s = star(lines_by_document(fx))
    return gold.top_stance_contexts(s.mentions, s.documents, s.dates, s.contexts, s.categories, s.audit)


# ---- gold, refreshed ----


def star(fx) -> incremental.Star:
    return incremental.Star(
        fx.m_mentions, fx.m_documents, fx.m_dates, fx.m_categories, fx.m_contexts, fx.m_audit,
        fx.m_bridge_creators, fx.m_creators, fx.m_bridge_subjects, fx.m_subjects,
    )


def star_before(fx) -> incremental.Star:
    return before_last_batch(star(fx))


def before_last_batch(now: incremental.Star) -> incremental.Star:
    """The star as it was before its last batch: without the documents that are not included, with
    mentions of January unscored, and with another name for some creators."""
    known = now.documents.where("included_in_analysis_flag").select("document_id")

    def earlier(rows):
        return rows.join(known, "document_id", "left_semi")

    unscored = F.coalesce(F.col("publication_month") == 1, F.lit(False))
    scores = ["stance_category_id", "stance_audit_id", "stance_score", "is_stance_scored"]
    changes = {c: F.when(~unscored, F.col(c)) for c in scores}
    renamed = F.when(F.col("creator_name").endswith("3"), F.lower("creator_name")).otherwise(F.col("creator_name"))
    tables = {table: earlier(getattr(now, table)) for table in incremental.PER_DOCUMENT}
    tables["mentions"] = tables["mentions"].withColumns(changes)
    return incremental.Star(**{**vars(now), **tables, "creators": now.creators.withColumn("creator_name", renamed)})


def stored(s: incremental.Star) -> incremental.Star:
    """The star as stages before leave it: tables that are stored."""
    return incremental.Star(**{table: materialize(rows) for table, rows in vars(s).items()})


def stored_by_document(fx) -> incremental.Star:
    """The same by document, so that what a document had before and has now meets without a shuffle."""
    if fx.folder in STAGED:
        kept = {t: _by_document_id(fx, t, r) if t in incremental.PER_DOCUMENT else r for t, r in vars(star(fx)).items()}
        return incremental.Star(**kept)
    return star(bridges_by_document(fx, lines_by_document(fx)))


def bridges_by_document(fx, by_document: Fixtures) -> Fixtures:
    """The same with bridges in buckets by document, and the tables of their members, stored."""
    creators = _by_document_id(fx, "creators", _suppliers_dealt(fx).m_bridge_creators, placed=True)
    subjects = _by_document_id(fx, "subjects", fx.m_bridge_subjects)
    kept = {"m_bridge_creators": creators, "m_bridge_subjects": subjects}
    kept |= {name: materialize(getattr(fx, name)) for name in ("m_creators", "m_subjects")}
    lines = {n: getattr(by_document, n) for n in ("m_documents", "m_lines", "m_dates", "m_categories")}
    return Fixtures(fx.spark, fx.folder, {**lines, **kept})


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows where the bucket of their document is written."""
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(buckets, F.col(key).cast("string"))


def _lines_dealt(fx) -> Fixtures:
    """Lines and their parts by document as they are read, which is narrower than what is made of them."""
    lines = fx.lineitem.join(fx.part.select("p_partkey", "p_name", "p_brand", "p_type"), F.expr("l_partkey = p_partkey"))
    return Fixtures(fx.spark, fx.folder, {"line_parts": _dealt(lines.drop("p_partkey"), "l_orderkey")})


def _mentions_dealt(fx) -> DataFrame:
    """Mentions of lines that are shuffled to their documents before their digests are made."""
    return fx.m_mentions if fx.folder in STAGED else _lines_dealt(fx).m_mentions


def _suppliers_dealt(fx) -> Fixtures:
    """Lines with their suppliers and orders by document, before names become digests."""
    named = fx.lineitem.select("l_orderkey", "l_suppkey", "l_linestatus", "l_linenumber").join(
        fx.supplier.select("s_suppkey", "s_name"), F.expr("l_suppkey = s_suppkey")
    )
    named = _dealt(named.drop("l_suppkey", "s_suppkey"), "l_orderkey")
    orders = _dealt(fx.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    same = F.col("l_orderkey").cast("string") == F.col("o_orderkey").cast("string")
    return Fixtures(fx.spark, fx.folder, {"line_suppliers": named.join(orders, same)})


def _by_document_id(fx, table: str, rows: DataFrame, placed: bool = False) -> DataFrame:
    name = f"{table}_{uuid.uuid4().hex}"
    buckets = int(fx.spark.conf.get("spark.sql.shuffle.partitions"))
    found = write_colocated(rows, name, _scratch(fx.spark, name), "document_id", buckets, placed)
    fx.spark.sql(f"DROP TABLE {name}")
    return found


def _refreshed(name: str) -> Callable[[Fixtures], DataFrame]:
    def run(fx):
        """A gold table built from the star before and brought to the star of now."""
        after = stored_by_document(fx)
        before = before_last_batch(after)
        tables = incremental.GoldTables(fx.spark, _scratch(fx.spark, "gold"), (name,), colocated=True)
        tables.build(before)
        tables.refresh(before, after, incremental.changed_documents(before, after))
        return tables.read(name, after)

    run.__name__ = f"gold_refreshed_{name}"
    return run


for _name in incremental.GROUPS:
    query(_refreshed(_name))


# ---- quality ----


def write_quality_tables(fx, tables: quality.MeasuredTables, placed: bool = False) -> None:
    """All tables of a corpus in the order of their making; ``placed`` bridges lie by document."""
    write = tables.write
    parsed = materialize(_parsed(fx))
    clean = write("silver_dim_document_text", texts.clean_document_text(fx.t_ocr))
    creators, subjects = documents.creator_entries(parsed), documents.subject_entries(parsed)
    lexicon_rows = _lexicon(fx)
    write("silver_fact_figure_mentions", fx.m_mentions)
    write("silver_dim_documents", fx.m_documents)
    write("silver_dim_stance_categories", fx.m_categories)
    write("silver_dim_mention_contexts", fx.m_contexts)
    write("silver_stance_model_audit", fx.m_audit)
    # Gold is made of the lines and bridges that lie by document, where none of these is moved.
    s = star(fx)
    by_document = gold.figure_stance_by_document(s.mentions, s.documents, s.dates, s.categories)
    write("gold_figure_stance_by_document", by_document)
    others = {
        "bronze_metadata": fx.t_metadata,
        "bronze_ocr_text": fx.t_ocr,
        "silver_fact_documents": texts.fact_documents_with_text(documents.fact_documents(parsed), clean),
        "silver_dim_dates": documents.dim_dates(parsed),
        "silver_publication_date_candidates": dates.mark_candidates(fx.c_candidates, _selected(fx)),
        "silver_dim_creators": documents.dim_creators(creators),
        "silver_bridge_document_creators": documents.bridge_creators(creators),
        "silver_dim_subjects": documents.dim_subjects(subjects),
        "silver_bridge_document_subjects": documents.bridge_subjects(subjects),
        "silver_dim_figures": figures.dim_figures(lexicon_rows),
        "silver_dim_figure_variants": figures.dim_variants(lexicon_rows),
        "gold_figure_mentions_by_period": gold.figure_mentions_by_period(s.mentions, s.dates, s.categories),
        "gold_figure_stance_by_period": gold.figure_stance_by_period(s.mentions, s.dates, s.categories),
        "gold_top_stance_contexts": gold.top_stance_contexts(
            s.mentions, s.documents, s.dates, s.contexts, s.categories, s.audit
        ),
        "gold_figure_stance_by_creator_period": gold.figure_stance_by_creator(
            by_document, s.creator_bridge, s.creators, placed
        ),
        "gold_figure_stance_by_subject_period": gold.figure_stance_by_subject(
            by_document, s.subject_bridge, s.subjects, placed
        ),
    }
    for name, rows in others.items():
        write(name, rows)


@query
def quality_metrics(fx):
    placed = fx.folder not in STAGED
    if placed:
        fx = bridges_by_document(fx, lines_by_document(fx))
    tables = quality.MeasuredTables(Tables(fx.spark, _scratch(fx.spark, "quality")))
    write_quality_tables(fx, tables, placed)
    return tables.metrics()


@query
def mention_summary(fx):
    return quality.mention_summary(fx.m_mentions)


@query
def stance_distribution(fx):
    return quality.stance_distribution(fx.m_mentions, fx.m_categories)
