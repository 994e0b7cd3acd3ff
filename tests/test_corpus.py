"""A corpus of seven documents through all stages, against sums worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from rostra.plans import corpus
from rostra.plans.quality import METRICS, MeasuredTables
from rostra.sources import lexicon
from rostra.sources.tables import Tables

WORDS = " ".join(["mot"] * 120)


def xml(document, title, date, creators=(), subjects=()):
    tags = [("title", title), ("date", date), ("identifier", document)]
    tags += [("creator", c) for c in creators] + [("subject", s) for s in subjects]
    return "<metadata>" + "".join(f"<{k}>{v}</{k}>" for k, v in tags) + "</metadata>"


METADATA = {
    "a": xml("a", "Adresse", "1791", ["Club A"], ["Paris"]),
    "b": xml("b", "Discours du 4 mars 1791", "1791", ["Club A", "Club B"], ["Paris", "Roi"]),
    "c": xml("c", "Lettre", "1792", ["Club B"]),
    "d": xml("d", "Sans date", "", ["Club B"]),
    "e": xml("e", "Rapport", "1792"),
    "f": xml("f", "Sans texte", "1791", ["Club A"]),
    "g": "<metadata><title>broken",
}
# "bon", "mal" and "tiede" beside a name are what the scorer below goes by.
TEXTS = {
    "a": f"{WORDS} le bon Danton parle. {WORDS}",
    "b": f"{WORDS} Danton, mal vu, et Danton mal servi. {WORDS} le bon Marat {WORDS}",
    "c": f"{WORDS} Marat mal entendu {WORDS}",
    "d": f"{WORDS} le bon Danton {WORDS}",
    "e": "",
    "g": f"{WORDS} Marat {WORDS}",
}
LEXICON = [("danton", "Georges Danton", "Danton", "high"), ("marat", "Jean-Paul Marat", "Marat", "high")]


def make_scorer():
    def scorer(prompts):
        out = []
        for prompt in prompts:
            words = prompt.split("Context window:\n")[1].replace("mot ", "")
            label = "positive" if "bon" in words else "negative" if "mal" in words else "neutral_or_unclear"
            out.append(json.dumps({
                "stance_label": label, "stance_intensity": "none" if label == "neutral_or_unclear" else "strong",
                "stance_confidence": "high", "target_relevance": "direct", "evidence_text": "vu", "explanation": "x"}))
        return out

    return scorer


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    metadata = spark.createDataFrame([(k, f"{k}_meta.xml", v) for k, v in METADATA.items()], "document_id string, file_path string, raw_metadata_xml string")
    ocr = spark.createDataFrame([(k, f"{k}_djvu.txt", v) for k, v in TEXTS.items()], "document_id string, file_path string, raw_text string").withColumn("source_file_type", F.lit("ocr_text"))
    lex = spark.createDataFrame([(f, n, v, None, "title", c, None) for f, n, v, c in LEXICON],
                                "figure_id string, canonical_name string, variant string, variant_normalized string, variant_type string, match_confidence string, notes string")
    tables = MeasuredTables(Tables(spark, root))
    metrics = corpus.run(tables, metadata, ocr, lexicon.validated_lexicon(lex), make_scorer(), "model-a")
    return tables, {r.metric_name: r.metric_value for r in metrics.collect()}


def table(built, name):
    return built[0].tables.read(name)


def test_gold_by_period(built):
    """1791: a (year) and b (a day in March); 1792: c. d has no date and g no metadata: not scored."""
    got = {(r.period_label, r.figure_id): r for r in table(built, "gold_figure_stance_by_period").collect()}
    assert {k: r.mention_count for k, r in got.items()} == {
        ("1791", "danton"): 1, ("1791-03", "danton"): 2, ("1791-03", "marat"): 1, ("1792", "marat"): 1,
        ("Unknown", "danton"): 1, ("Unknown", "marat"): 1}
    assert {k: r.avg_stance_score for k, r in got.items()} == {
        ("1791", "danton"): 1.0, ("1791-03", "danton"): -1.0, ("1791-03", "marat"): 1.0, ("1792", "marat"): -1.0,
        ("Unknown", "danton"): None, ("Unknown", "marat"): None}
    assert [k for k, r in got.items() if not r.is_analysis_ready] == [k for k in got if k[0] == "Unknown"]


def test_gold_by_creator_and_subject(built):
    got = {(r.creator_name, r.period_label, r.figure_id): (r.document_count, r.mention_count, r.avg_stance_score)
           for r in table(built, "gold_figure_stance_by_creator_period").collect()}
    assert got == {
        ("Club A", "1791", "danton"): (1, 1, 1.0), ("Club A", "1791-03", "danton"): (1, 2, -1.0),
        ("Club A", "1791-03", "marat"): (1, 1, 1.0), ("Club B", "1791-03", "danton"): (1, 2, -1.0),
        ("Club B", "1791-03", "marat"): (1, 1, 1.0), ("Club B", "1792", "marat"): (1, 1, -1.0),
        ("Club B", "Unknown", "danton"): (1, 1, None), ("Unknown", "Unknown", "marat"): (1, 1, None)}
    subjects = {(r.subject, r.period_label, r.figure_id) for r in table(built, "gold_figure_stance_by_subject_period").collect()}
    assert ("Roi", "1791-03", "marat") in subjects and ("Unknown", "1792", "marat") in subjects


def test_gold_by_document_and_evidence(built):
    got = {(r.document_id, r.figure_id): r.document_stance_label for r in table(built, "gold_figure_stance_by_document").collect()}
    assert got[("a", "danton")] == "positive" and got[("b", "danton")] == "negative" and got[("d", "danton")] == "not_included"
    top = table(built, "gold_top_stance_contexts").where("figure_id = 'danton' AND document_id = 'b'").collect()
    assert sorted(r.absolute_stance_rank_by_figure_period for r in top) == [1, 2]
    assert all("Danton" in r.context_window for r in top)


def test_metrics_of_the_corpus(built):
    """What was counted while writing is what the stored tables hold."""
    tables, metrics = built
    assert metrics["bronze_metadata_rows"] == 7 and metrics["silver_fact_figure_mentions_rows"] == 7
    assert metrics["stance_scored_mentions"] == 5 and metrics["silver_stance_model_audit_rows"] == 5
    assert metrics["distinct_figures"] == 2 and metrics["empty_text_documents"] >= 1
    for name in METRICS:
        rows = next(metric for _, metric, condition in METRICS[name] if condition == "true")
        assert tables.tables.read(name).count() == metrics[rows], name


def test_stages_can_be_repeated(built):
    tables, metrics = built
    assert corpus.score_mentions(tables, make_scorer(), "model-a") == 0
    corpus.build_gold(tables)
    assert {r.metric_name: r.metric_value for r in tables.metrics().collect()} == metrics


def test_gold_plans(built):
    """Mentions are scanned once and aggregated before they are shuffled."""
    s = corpus.star(built[0])
    from rostra.plans import gold

    plan = gold.figure_stance_by_period(s.mentions, s.dates, s.categories)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("mention_id#") <= 2 and "Join FullOuter" not in plan
    assert plan.count("Aggregate [period_label") == 2
    text = gold.figure_stance_by_document(s.mentions, s.documents, s.dates, s.categories)._jdf.queryExecution().optimizedPlan().toString()
    # Documents and dates join after the aggregate: it lies below both joins.
    assert text.index("Join") < text.index("Aggregate [document_id")
