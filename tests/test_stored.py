"""Ordered and co-located tables, load stamps, replies that are kept, metrics of written tables."""

import os
import re

import pytest
from pyspark.sql import functions as F

from rostra.operators.contexts import mention_contexts
from rostra.operators.mentions import find_mentions
from rostra.plans import figures, quality, replies
from rostra.sources import lexicon, ordered, parts
from rostra.sources.tables import Tables, write_colocated


def test_files_and_rows_in_order(spark, tmp_path):
    """One value has half of the rows: the columns after it cut it into several files."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 5).cast("int").alias("a"),
        (F.col("id") * 37 % 4001).alias("b"),
    )
    path = str(tmp_path / "t")
    assert ordered.write_ordered(rows, path, "-a", "b", files=8) == 4000
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert 6 <= len(files) <= 8
    got = [tuple(r) for f in files for r in spark.read.parquet(f"{path}/{f}").collect()]
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1])
    assert got == sorted(got, key=key) and len(got) == 4000
    hot = [f for f in files if spark.read.parquet(f"{path}/{f}").where("a = 7").count()]
    assert len(hot) >= 4
    again = ordered.read_ordered(spark, path).orderBy("file", "place").select("a", "b").collect()
    assert [tuple(r) for r in again] == got
    assert ordered.write_ordered(rows.limit(0), path, "a", require_rows=False) == 0


def texts_and_mentions(spark):
    texts = spark.createDataFrame(
        [(f"d{i}", f"avant robespierre et marat {i} danton apres", "p") for i in range(300)],
        "document_id string, clean_text string, file_path string",
    ).withColumn("clean_text_lower", F.col("clean_text"))
    variants = spark.createDataFrame(
        [("f", v, v, v) for v in ("robespierre", "marat", "danton")],
        "figure_id string, variant_id string, variant string, variant_normalized string",
    )
    return texts, find_mentions(texts, variants)


def test_contexts_of_colocated_tables_move_no_text(spark, tmp_path):
    texts, found = texts_and_mentions(spark)
    stored = [write_colocated(rows, name, str(tmp_path / name), "document_id", buckets=6)
              for name, rows in (("texts_t", texts), ("mentions_t", found))]
    for name in ("texts_t", "mentions_t"):
        files = [f for f in os.listdir(tmp_path / name) if f.endswith(".parquet")]
        assert len(files) == len({re.search(r"_(\d{5})\.", f)[1] for f in files})
        spark.sql(f"DROP TABLE {name}")
    cut = mention_contexts(stored[1], stored[0].hint("merge"), 2, 2)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    want = mention_contexts(found, texts, 2, 2)
    assert sorted(cut.collect()) == sorted(want.collect()) and cut.count() == 900


def test_stamps_come_from_the_files(spark, tmp_path):
    head = ",".join(lexicon.LEXICON_COLUMNS)
    for name, at, rows in (("a", 1_000_000_000, ["f1,One,un,,title,high,", "f2,Two,deux,,title,low,"]), ("b", 1_200_000_000, ["f1,One,une,,title,low,"])):
        file = tmp_path / f"{name}.csv"
        file.write_text("\n".join([head, *rows]) + "\n")
        os.utime(file, (at, at))
    stamped = lexicon.validated_lexicon(lexicon.read_stamped_lexicon_csv(spark, str(tmp_path)))
    got = {r.figure_id: (r.variant_count, int(r.at)) for r in
           figures.dim_figures(stamped).withColumn("at", F.unix_timestamp("loaded_at")).collect()}
    assert got == {"f1": (2, 1_000_000_000), "f2": (1, 1_000_000_000)}
    assert "loaded_at" not in figures.dim_figures(lexicon.read_lexicon_csv(spark, str(tmp_path))).columns


def test_replies_are_asked_for_once(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)
    refused = str(tmp_path / "refuse")
    open(refused, "w").close()

    def scorer(prompts):
        if "bad" in prompts and os.path.exists(refused):
            raise RuntimeError("refused")
        asked.add(len(prompts))
        return [prompt.upper() for prompt in prompts]

    tables = Tables(spark, str(tmp_path / "tables"))
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(["x", "y", "x", "bad", None, "x", "bad"])], "id int, prompt string")
    first = {r.id: (r.raw_response, r.error) for r in replies.ask(rows, scorer, tables, "m").collect()}
    refusal = (None, "RuntimeError: refused")
    assert first == {0: ("X", None), 1: ("Y", None), 2: ("X", None), 3: refusal, 4: ("", None), 5: ("X", None), 6: refusal}
    assert asked.value == 3
    os.remove(refused)
    more = rows.unionByName(spark.createDataFrame([(9, "z")], rows.schema))
    second = {r.id: (r.raw_response, r.error) for r in replies.ask(more, scorer, tables, "m").collect()}
    assert second == first | {3: ("BAD", None), 6: ("BAD", None), 9: ("Z", None)}
    assert asked.value == 5
    # Another model has replies of its own.
    assert replies.ask(rows, scorer, tables, "n").count() == 7 and asked.value == 9


def test_a_scorer_with_too_few_replies(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, prompt string")
    found = replies.ask(rows.coalesce(1), lambda prompts: prompts[:1], Tables(spark, str(tmp_path)), "m")
    assert {r.raw_response for r in found.collect()} == {"a", "b"}


def test_metrics_are_counted_while_writing(spark, tmp_path):
    tables = quality.MeasuredTables(Tables(spark, str(tmp_path)))
    rows = spark.createDataFrame([(True, "x"), (False, ""), (None, "y")], "is_analysis_ready boolean, context_window string")
    written = tables.write("gold_top_stance_contexts", rows)
    assert written.count() == 3 and tables.write("other", rows).count() == 3
    tables.write("silver_dim_mention_contexts", rows.repartition(5))
    got = {n: v for n, v in tables.values.items()}
    assert got == {"gold_top_stance_contexts_rows": 3, "analysis_ready_top_stance_context_rows": 1,
                   "silver_dim_mention_contexts_rows": 3, "empty_mention_contexts": 1}
    with pytest.raises(ValueError, match="bronze_metadata"):
        tables.metrics()
    for name, metrics in quality.METRICS.items():
        tables.values |= {metric: tables.values.get(metric, 0) for _, metric, _ in metrics}
    assert tables.store().count() == 57
    resumed = quality.MeasuredTables(Tables(spark, str(tmp_path)))
    resumed.write("silver_dim_mention_contexts", rows.limit(1))
    assert resumed.values["silver_dim_mention_contexts_rows"] == 1
    assert resumed.values["gold_top_stance_contexts_rows"] == 3 and resumed.metrics().count() == 57


def test_replaced_parts_are_written_once(spark, tmp_path, monkeypatch):
    """Rows that come from the replaced files go straight beside them, and not through another copy."""
    rows = spark.createDataFrame([(str(i), i) for i in range(50)], "k string, v int")
    table = parts.PartedTable(spark, str(tmp_path / "t"), rows.schema, ["k"], parts=4)
    table.write(rows)
    monkeypatch.setattr(parts, "materialize", None)
    table.replace(table.read([0, 1]).where("v % 2 = 0"), [0, 1])
    left = {r.k for r in table.read().collect()}
    own = {r.k: r.part for r in rows.select("k", table.part().alias("part")).collect()}
    assert left == {k for k in own if own[k] > 1 or int(k) % 2 == 0}
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    table.replace(table.read([2]).limit(0), [2])
    assert {own[r.k] for r in table.read().collect()} == {0, 1, 3}
