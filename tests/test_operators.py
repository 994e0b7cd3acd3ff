"""Selection, ranking, upserts, stance, sources and the resumable run."""

import random

import pytest
from pyspark.sql import functions as F

from rostra.functions import stance as st
from rostra.operators.ranking import ranked_in_groups
from rostra.operators.upserts import merge_insert_only, merge_update, merge_upsert
from rostra.plans import dates, stance
from rostra.plans.quality import METRICS, quality_metrics
from rostra.sources import files, lexicon, manifest
from rostra.sources import tables as tables_module
from rostra.sources.tables import (
    Tables, clear_materialized, materialize, release, released, with_missing_columns, write_table,
)
from rostra.streaming.resumable import current_audit, publish_mentions, score_next_batch, scored_mentions


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_ranks_of_a_hot_group(spark, buckets):
    """A third of all rows in one group, one document with half of those."""
    pick = random.Random(7)
    rows = []
    for i in range(1500):
        hot = i % 3 == 0
        group = None if hot else pick.randrange(5)
        document = "hot" if hot and i % 2 else f"d{pick.randrange(40)}"
        rows.append((group, pick.choice([-1.0, -0.33, 0.0, 0.33, 1.0]), pick.choice([1, 2]),
                     document, f"m{i:05d}"))
    frame = spark.createDataFrame(rows, "g int, score double, q int, doc string, id string")
    frame = frame.withColumn("size", F.abs("score"))
    ranked = ranked_in_groups(
        frame, ["g"], ["doc", "id"],
        {"a": [("size", "desc"), ("q", "desc")], "p": [("score", "desc"), ("q", "desc")],
         "n": [("score", "asc"), ("q", "desc")]},
        buckets=buckets,
    )
    got = {r.id: (r.a, r.p, r.n) for r in ranked.collect()}
    assert len(got) == len(rows)
    for group in {r[0] for r in rows}:
        members = [r for r in rows if r[0] == group]
        orders = [lambda r: -abs(r[1]), lambda r: -r[1], lambda r: r[1]]
        for position, order in enumerate(orders):
            members.sort(key=lambda r: (order(r), -r[2], r[3], r[4]))
            assert [got[r[4]][position] for r in members] == list(range(1, len(members) + 1))


def test_upserts(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", None), ("c", 3)], "k string, v int")

    def rows(frame):
        return sorted(tuple(r) for r in frame.collect())

    assert rows(merge_insert_only(target, source, "k")) == [("a", 1), ("b", 2), ("c", 3)]
    once = merge_upsert(target, source, "k")
    assert rows(once.where("v is not null")) == [("a", 1), ("c", 3)] and once.count() == 3
    assert merge_upsert(once, source, "k").count() == 3
    updated = merge_update(target, source, "k", {"v": F.col("v"), "seen": F.lit(True)})
    assert {r.k: (r.v, r.seen) for r in updated.collect()} == {"a": (1, None), "b": (None, True)}
    with pytest.raises(Exception, match="more than one source row"):
        merge_upsert(target, source.union(source), "k").collect()


def candidate(document, name, year, precision="day", confidence="high", extractor="x", score=None,
              field="f"):
    return (name, document, extractor, "1", field, year, 1, 1, None, precision, "gregorian",
            confidence, score, None, None, None, False)


SCHEMA = (
    "date_candidate_id string, document_id string, extractor_name string, extractor_version string, "
    "candidate_source_field string, candidate_publication_year int, candidate_publication_month int, "
    "candidate_publication_day int, candidate_publication_date date, candidate_date_precision string, "
    "candidate_date_calendar string, candidate_confidence string, candidate_confidence_score double, "
    "candidate_evidence string, raw_extraction string, source_text_excerpt string, "
    "selected_for_document boolean"
)


def test_selection_order(spark):
    rule = "rule_based_metadata_title_ocr"
    rows = [
        candidate("conflict", "1", 1790), candidate("conflict", "2", 1789, "year", "low"),
        candidate("precision", "1", 1789, "month"), candidate("precision", "2", 1789, "day", "low"),
        candidate("confidence", "1", 1789, confidence="low"), candidate("confidence", "2", 1789, confidence="medium"),
        candidate("extractor", "1", 1789, extractor="model_extract"), candidate("extractor", "2", 1789, extractor=rule),
        candidate("score", "1", 1789, score=0.1), candidate("score", "2", 1789, score=0.2),
        candidate("field", "1", 1789, field="b"), candidate("field", "2", 1789, field="a"),
        candidate("id", "3", 1789), candidate("id", "2", 1789),
        candidate("none", "1", 1789, "unknown"), candidate("none", "2", None, "revolutionary_month"),
    ]
    candidates = spark.createDataFrame(rows, SCHEMA)
    documents = spark.createDataFrame(
        [(d, "[1789]") for d in {r[1] for r in rows}], "document_id string, publication_date_raw string")
    selected = dates.select_dates(candidates, documents).collect()
    assert {r.document_id for r in selected} == {r[1] for r in rows} - {"none"}
    assert {r.selected_date_candidate_id for r in selected} == {"2"}


def test_stance_replies(spark):
    replies = {
        "fenced": '```json\n{"stance_label": "Positive", "stance_intensity": "STRONG", "stance_confidence": "high", "target_relevance": "direct"}\n```',
        "broken": '{"stance_label": "positive"',
        "unknown": '{"stance_label": "hostile", "stance_intensity": "strong"}',
        "bare": '{"stance_label": "negative"}',
        "neutral": '{"stance_label": "neutral_or_unclear", "stance_intensity": "strong"}',
        "none": None,
    }
    frame = spark.createDataFrame(list(replies.items()), "mention_id string, raw_response string")
    scored = stance.score_replies(stance.normalize_replies(frame), "m")
    got = {r.mention_id: (r.stance_label, r.stance_intensity, r.stance_confidence,
                          r.target_relevance, r.stance_score) for r in scored.collect()}
    unclear = ("neutral_or_unclear", "none", "low", "not_relevant", 0.0)
    assert got == {"fenced": ("positive", "strong", "high", "direct", 1.0), "broken": unclear,
                   "unknown": unclear, "neutral": unclear, "none": unclear,
                   "bare": ("negative", "weak", "low", "not_relevant", -0.33)}


def test_file_scans(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x1_meta.xml").write_text("<m/>", "utf-8")
    (tmp_path / "a" / "notes.xml").write_text("<m/>", "utf-8")
    (tmp_path / "x1_djvu.txt").write_bytes("é".encode() + b"\xff")
    meta = files.read_metadata_files(spark, str(tmp_path)).collect()
    assert [(r.document_id, r.raw_metadata_xml) for r in meta] == [("x1", "<m/>")]
    text = files.read_ocr_text_files(spark, str(tmp_path)).collect()
    assert [(r.document_id, r.raw_text, r.source_file_type) for r in text] == [("x1", "é�", "ocr_text")]


HEADER = ",".join(lexicon.LEXICON_COLUMNS)


def test_lexicon(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text(f"﻿{HEADER}\nf, F ,A  B,,title,high,\ng,G,C,c,title,low,note\n", "utf-8")
    rows = {r.figure_id: r for r in lexicon.validated_lexicon(lexicon.read_lexicon_csv(spark, str(good))).collect()}
    assert (rows["f"].canonical_name, rows["f"].variant_normalized, rows["f"].notes) == ("F", "a b", None)
    bad = tmp_path / "bad.csv"
    bad.write_text(f"{HEADER}\nf,F,A,a,title,,\nf,G,A,a,title,high,\n", "utf-8")
    with pytest.raises(ValueError, match="invalid_rows: 1.*duplicate_variants: 1.*conflicting_figure_names: 1"):
        lexicon.validated_lexicon(lexicon.read_lexicon_csv(spark, str(bad)))
    short = tmp_path / "short.csv"
    short.write_text("figure_id,variant\nf,a\n", "utf-8")
    with pytest.raises(ValueError, match="lacks columns"):
        lexicon.read_lexicon_csv(spark, str(short))


def test_manifest(spark, tmp_path):
    path = tmp_path / "ids.txt"
    path.write_text("﻿a-1\n\n b.2 \n", "utf-8")
    assert sorted(r.document_id for r in manifest.read_manifest(spark, str(path)).collect()) == ["a-1", "b.2"]
    path.write_text("a b\n", "utf-8")
    with pytest.raises(ValueError, match="not valid"):
        manifest.read_manifest(spark, str(path))
    path.write_text("\n", "utf-8")
    with pytest.raises(ValueError, match="empty"):
        manifest.read_manifest(spark, str(path))


def test_tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.write("t", spark.range(3).toDF("a"))
    rewritten = tables.write("t", tables.read("t").where("a > 0").withColumn("b", F.lit("x")))
    assert sorted(tuple(r) for r in rewritten.collect()) == [(1, "x"), (2, "x")]
    with pytest.raises(RuntimeError, match="no rows"):
        tables.write("t", tables.read("t").where("a > 9"))
    assert tables.read("t").count() == 2
    assert write_table(spark.range(5), str(tmp_path / "plain")) == 5
    assert tables.create_if_missing("e", "a int").count() == 0
    wider = with_missing_columns(spark.range(1), {"id": "string", "c": "double"})
    assert wider.dtypes == [("id", "bigint"), ("c", "double")]
    kept = materialize(spark.range(4))
    assert kept.count() == 4 and "rostra-" in kept.inputFiles()[0]
    clear_materialized(spark)
    with pytest.raises(Exception, match="[Ff]ile"):
        materialize(spark.range(1))
        kept.count()


def test_resumable_scoring(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    n = 10
    mentions = spark.range(n).select(
        F.format_string("m%02d", "id").alias("mention_id"), F.lit("d").alias("document_id"),
        F.lit("f").alias("figure_id"), F.lit("v").alias("variant_id"),
        F.lit("F").alias("canonical_name"), F.lit("f").alias("matched_variant"),
        F.lit(1789).alias("publication_year"), F.lit(None).cast("int").alias("publication_month"),
        F.lit("high").alias("match_confidence"), (F.col("id") < 8).alias("is_analysis_ready"))
    tables.write("silver_fact_figure_mentions", mentions)
    tables.write("silver_dim_mention_contexts", mentions.select(
        "mention_id", F.when(F.col("mention_id") == "m00", "").otherwise("mot").alias("context_window"),
        F.lit(1).alias("context_word_count"), F.lit(0).alias("context_start_char"),
        F.lit(3).alias("context_end_char")))
    tables.write("silver_dim_documents", spark.createDataFrame([("d", "T")], "document_id string, title string"))

    def scorer(prompts):
        return ['{"stance_label": "positive", "stance_confidence": "high"}' for _ in prompts]

    sizes = [score_next_batch(tables, scorer, "model-a", limit=4) for _ in range(3)]
    assert sizes == [4, 3, 0]
    audit = tables.read("silver_stance_model_audit")
    assert audit.count() == 7 and audit.select("mention_id").distinct().count() == 7
    assert tables.read("silver_dim_stance_categories").count() == 1
    facts = publish_mentions(tables)
    assert facts.count() == n and facts.where("is_stance_scored").count() == 7
    assert facts.where("stance_score = 0.33 and is_medium_or_high_stance_confidence").count() == 7
    assert score_next_batch(tables, scorer, "model-a", limit=None, include_scored=True) == 7
    assert current_audit(tables).count() == 7
    # What the versions before left behind goes, the rows stay.
    assert tables.expire("silver_fact_figure_mentions") == 2
    assert tables.read("silver_fact_figure_mentions").count() == n


@pytest.mark.parametrize("broken", ["silver_dim_stance_categories", "silver_stance_model_audit"])
def test_a_broken_run_loses_no_score(spark, tmp_path, monkeypatch, broken):
    """Whatever write fails, the next runs end with every mention scored."""
    tables = Tables(spark, str(tmp_path))
    mentions = spark.range(4).select(
        F.col("id").cast("string").alias("mention_id"), F.lit("d").alias("document_id"),
        F.lit("f").alias("figure_id"), F.lit("v").alias("variant_id"),
        F.lit("F").alias("canonical_name"), F.lit("f").alias("matched_variant"),
        F.lit(1789).alias("publication_year"), F.lit(None).cast("int").alias("publication_month"),
        F.lit("high").alias("match_confidence"), F.lit(True).alias("is_analysis_ready"))
    tables.write("silver_fact_figure_mentions", mentions)
    tables.write("silver_dim_mention_contexts", mentions.select(
        "mention_id", F.lit("mot").alias("context_window"), F.lit(1).alias("context_word_count"),
        F.lit(0).alias("context_start_char"), F.lit(3).alias("context_end_char")))
    tables.write("silver_dim_documents", spark.createDataFrame([("d", "T")], "document_id string, title string"))
    append = Tables.append

    def failing(self, name, rows):
        if name == broken:
            raise OSError("lost")
        return append(self, name, rows)

    def scorer(prompts):
        return ['{"stance_label": "negative", "stance_confidence": "high"}' for _ in prompts]

    monkeypatch.setattr(Tables, "append", failing)
    with pytest.raises(OSError):
        score_next_batch(tables, scorer, "m", limit=2)
    monkeypatch.setattr(Tables, "append", append)
    before = {f: f.stat().st_mtime_ns for f in tmp_path.glob("silver_fact_figure_mentions/*/part-*")}
    sizes = [score_next_batch(tables, scorer, "m", limit=2) for _ in range(3)]
    assert sum(sizes) == 4 and sizes[-1] == 0
    assert before == {f: f.stat().st_mtime_ns for f in before}
    scored = scored_mentions(tables)
    assert scored.count() == 4 and scored.where("is_stance_scored").count() == 4


def test_an_empty_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(3), path) == 3
    with pytest.raises(RuntimeError, match="no rows"):
        write_table(spark.range(0), path)
    assert spark.read.parquet(path).count() == 3
    assert write_table(spark.range(2), path) == 2 and spark.read.parquet(path).count() == 2
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_two_writers_do_not_share_a_version(spark, tmp_path):
    one, two = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    one.write("t", spark.range(1))
    stale = two._versions("t")
    one.write("t", spark.range(2))
    two._versions = lambda name: stale
    with pytest.raises(Exception, match="exist"):
        two.write("t", spark.range(9))
    assert one.read("t").count() == 2
    one.append("t", spark.range(5, 8))
    assert sorted(r.id for r in one.read("t").collect()) == [0, 1, 5, 6, 7]


class Failing:
    """A file system whose renames to a target that ends in ``name`` fail ``times`` times."""

    def __init__(self, files, name, times=1):
        self.files, self.name, self.times = files, name, times

    def __getattr__(self, attribute):
        return getattr(self.files, attribute)

    def rename(self, source, target):
        if self.times and target.getName() == self.name:
            self.times -= 1
            raise OSError("broken off")
        return self.files.rename(source, target)


def test_a_crash_before_publishing_leaves_nothing_that_counts(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path))
    tables.write("t", spark.range(2))
    located = tables_module._located
    with monkeypatch.context() as broken:
        broken.setattr(tables_module, "_located", lambda s, p: (lambda path, files: (path, Failing(files, "000002")))(*located(s, p)))
        with pytest.raises(OSError, match="broken off"):
            tables.append("t", spark.range(7, 9))
    assert tables.read("t").count() == 2
    tables.append("t", spark.range(5, 6))
    assert sorted(r.id for r in tables.read("t").collect()) == [0, 1, 5]
    assert [number for number, _, _ in tables._versions("t")] == [1, 2]


def test_a_crash_between_renames_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    located = tables_module._located
    with monkeypatch.context() as broken:
        once = {}
        broken.setattr(
            tables_module, "_located",
            lambda s, p: (lambda at, files: (at, once.setdefault("files", Failing(files, "t"))))(*located(s, p)),
        )
        with pytest.raises(OSError, match="broken off"):
            write_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    assert write_table(spark.range(4), path) == 4


def test_released_tables(spark):
    with released(spark) as keep:
        first = materialize(spark.range(3))
        with released(spark) as inner:
            kept = inner(first.where("id > 0"))
            gone = materialize(spark.range(9))
        result = keep(kept.where("id > 1"))
    assert [r.id for r in result.collect()] == [2]
    for table in (first, gone, kept):
        with pytest.raises(Exception, match="exist"):
            spark.read.parquet(table._rostra_location)
    release(result)
    with pytest.raises(Exception, match="exist"):
        spark.read.parquet(result._rostra_location)


def test_empty_files_are_rows(spark, tmp_path):
    for name, text in (("a b+1", "x"), ("ü", ""), ("c%20", "")):
        (tmp_path / f"{name}_djvu.txt").write_text(text)
    rows = {r.document_id: r.raw_text for r in files.read_ocr_text_files(spark, str(tmp_path)).collect()}
    assert len(rows) == 3 and rows["ü"] == "" and sorted(rows.values()) == ["", "", "x"]


def test_conflicting_documents_leave_the_analysis(spark):
    columns = ("document_id string, mention_id string, figure_id string, date_key string, publication_year int, "
               "publication_month int, publication_day int, publication_date date, date_precision string, "
               "date_calendar string, included_in_analysis_flag boolean, is_medium_or_high_stance_confidence boolean")
    rows = [(d, d, "f", None, 1790, None, None, None, "year", "gregorian", flag, True)
            for d, flag in (("conflict", True), ("fine", True), ("now", False), ("other", True))]
    selected = spark.createDataFrame(
        [(d, "k", 1791, None, None, None, "year", "gregorian", d == "conflict") for d in ("conflict", "fine", "now")],
        "document_id string, date_key string, publication_year int, publication_month int, publication_day int, "
        "publication_date date, date_precision string, date_calendar string, conflicts_with_metadata_year boolean")
    facts = spark.createDataFrame([("conflict", False), ("fine", True), ("now", True)],
                                  "document_id string, included_in_analysis_flag boolean")
    got = dates.mentions_after_selection(spark.createDataFrame(rows, columns), selected, facts)
    ready = {r.document_id: (r.is_analysis_ready, r.publication_year) for r in got.collect()}
    assert ready == {"conflict": (False, 1791), "fine": (True, 1791), "now": (True, 1791), "other": (True, 1790)}


def test_quality_needs_every_table(spark):
    with pytest.raises(ValueError, match="silver_dim_documents"):
        quality_metrics({"bronze_metadata": spark.range(1)})


def test_scores(spark):
    cells = [(la, i) for la in st.STANCE_LABELS for i in ("none", *st.STANCE_INTENSITIES)]
    frame = spark.createDataFrame(cells, "l string, i string")
    got = {(r.l, r.i): r.s for r in frame.select("*", st.stance_score(F.col("l"), F.col("i")).alias("s")).collect()}
    assert got[("negative", "moderate")] == -0.66 and got[("positive", "strong")] == 1.0
    assert str(got[("negative", "none")]) == "0.0" and got[("neutral_or_unclear", "strong")] == 0.0


def test_metric_catalogue():
    names = [name for metrics in METRICS.values() for _, name, _ in metrics]
    assert len(names) == len(set(names)) == 57 and len(METRICS) == 23
