"""How the star that gold is refreshed from is stored."""

import datetime
import re
from pathlib import Path

from pyspark.sql import functions as F

from checks.fixtures import Fixtures
from checks.queries import _audit_with_later_rows, _mentions_dealt, before_last_batch, star, star_before, stored, stored_by_document
from rostra.functions.common import packed_digest, unpacked_digest
from rostra.operators.ranking import ranked_in_groups
from rostra.plans import gold, incremental
from rostra.sources.parts import PartedTable
from rostra.sources.tables import materialize, release


def write_given(spark, folder):
    """Twelve orders of three lines, one order without a key, one that comes twice and a line without its order."""
    day = datetime.datetime(1995, 1, 3)
    status, priority = "FOP", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    orders = [
        (None if k == 11 else k, k % 3, status[k % 3], 10.0, day + datetime.timedelta(days=20 * k), priority[k % 5])
        for k in [*range(12), 4]
    ]
    lines = [
        (k, n % 4, n % 2, n, 20.0, 5.0 + n, 0.01 * ((k or 0) % 11), 0.03, "ARN"[(k or 0) % 3], "OF"[n % 2], day)
        for k in [*range(11), None, 99] for n in (1, 3, 7)
    ]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string, l_shipdate timestamp"),
        "customer": ([(k, f"Customer {k}", 1, 2.0, f"segment {k}") for k in range(3)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(k, f"Supplier {k}3", 1, 2.0) for k in range(2)],
                     "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(k, f"red rod {k}", f"Brand#{k}", "PROMO", k, 1.0) for k in range(4)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_a_star_by_document_meets_its_former_self_without_a_shuffle(spark, tmp_path):
    fx = Fixtures(spark, write_given(spark, tmp_path))
    after = stored_by_document(fx)
    before, plain = before_last_batch(after), star_before(fx)
    for table in vars(plain):
        columns = sorted(getattr(plain, table).columns)
        assert sorted(getattr(before, table).columns) == columns
        old, new = (getattr(s, table).select(*columns) for s in (plain, before))
        assert new.count() > 0
        assert old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        states = [
            getattr(before, table).groupBy("document_id").count()._jdf.queryExecution().executedPlan().toString()
            for table in incremental.PER_DOCUMENT
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for plan in states:
        assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_digests_are_stored_in_half_their_digits(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).coalesce(1)
    made = PartedTable(spark, str(tmp_path / "parts"), rows.schema, ["k"], parts=1)
    kept = materialize(rows)
    for write in (lambda: made.write(rows), lambda: made.replace(rows, [0])):
        write()
        assert sum(f.stat().st_size for f in Path(made.path).rglob("*.parquet")) < 20_000 * 64 * 0.75
    assert sum(f.stat().st_size for f in Path(kept._rostra_location).rglob("*.parquet")) < 20_000 * 64 * 0.75
    release(kept)
    assert made.read().count() == 20_000


def plan_of(spark, rows):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        return rows()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_evidence_is_joined_once(spark, tmp_path):
    s = stored(star(Fixtures(spark, write_given(spark, tmp_path))))
    top = gold.top_stance_contexts(s.mentions, s.documents, s.dates, s.contexts, s.categories, s.audit)
    assert top.count() > 0
    # The texts of the audit are joined; the audit that decides what is evidence is not read again.
    read = top.inputFiles()
    assert not any(s.categories._rostra_location in f for f in read)
    assert any(s.audit._rostra_location in f for f in read)


def test_ranked_rows_are_moved_once(spark):
    rows = spark.createDataFrame(
        [(None if i % 5 == 0 else i % 3, float(i % 4), i % 2, f"d{i % 9}", i, "wide") for i in range(200)],
        "g int, score double, q int, doc string, id int, wide string",
    )
    rankings = {"p": [("score", "desc"), ("q", "desc")], "n": [("score", "asc"), ("q", "desc")]}
    plan = plan_of(spark, lambda: ranked_in_groups(rows, ["g"], ["doc", "id"], rankings, buckets=4))
    # Once for the places; the others carry counts of cells.
    assert plan.count("REPARTITION_BY_COL") == 1
    top = plan[: plan.index("Window")]
    assert "Exchange" not in top


def test_mentions_contexts_and_audit_are_made_of_the_lines_of_a_document(spark, tmp_path):
    after = stored_by_document(Fixtures(spark, write_given(spark, tmp_path)))
    lines = set(after.contexts.inputFiles())
    assert lines and set(after.audit.inputFiles()) == lines and lines < set(after.mentions.inputFiles())


def test_what_lies_by_document_is_aggregated_and_expanded_where_it_lies(spark, tmp_path):
    after = stored_by_document(Fixtures(spark, write_given(spark, tmp_path)))
    periods = gold.figure_mentions_by_period(after.mentions, after.dates, after.categories)
    tables = incremental.GoldTables(spark, str(tmp_path / "gold"), colocated=True)
    for rows in (periods, tables._plan("stance_by_creator", after)):
        assert rows.count() > 0
        plan = re.sub(r"#\d+L?", "", rows._jdf.queryExecution().executedPlan().toString())
        dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
        assert dealt and not any("document_id" in keys or "member" in keys for keys in dealt)


def test_documents_and_variants_of_a_period_are_distinct(spark):
    mentions = spark.createDataFrame(
        [("a", "v", 1), ("a", "w", 2), ("b", "v", 3), ("b", None, 4), (None, "x", 5), (None, "x", 6)],
        "document_id string, variant_id string, mention_id int",
    ).selectExpr(
        "*", "'k' AS date_key", "'f' AS figure_id", "'F' AS canonical_name", "'high' AS match_confidence",
        "true AS is_high_confidence_match", "mention_id < 3 AS is_analysis_ready", "'c' AS stance_category_id",
        "cast(0.5 AS double) AS stance_score",
    )
    dates = spark.sql(
        "SELECT 'k' AS date_key, '1790' AS period_label, 1790 AS publication_year, cast(NULL AS int) AS publication_month, "
        "cast(NULL AS int) AS publication_day, cast(NULL AS date) AS publication_date, 'year' AS date_precision, "
        "'gregorian' AS date_calendar"
    )
    categories = spark.sql(
        "SELECT 'c' AS stance_category_id, 'positive' AS stance_label, 'weak' AS stance_intensity, "
        "'high' AS stance_confidence, 'direct' AS target_relevance"
    )
    (row,) = gold.figure_mentions_by_period(mentions, dates, categories).collect()
    assert (row.mention_count, row.document_count, row.matched_variant_count) == (6, 2, 3)
    assert (row.analysis_ready_mention_count, row.analysis_ready_document_count) == (2, 1)


def test_mentions_and_audit_of_the_upserts_are_derived_once(spark, tmp_path):
    fx = Fixtures(spark, write_given(spark, tmp_path))
    later = fx.m_audit.where("evidence_text IS NULL").withColumns(
        {
            "stance_audit_id": F.concat("stance_audit_id", F.lit("-b")),
            "stance_category_id": F.lit("gone"),
            "ship_date": F.date_add("ship_date", 1),
        }
    )
    want, got = fx.m_audit.unionByName(later).withColumnRenamed("ship_date", "stance_scored_at"), _audit_with_later_rows(fx)
    assert got.columns == want.columns and later.count() > 0
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
    assert plan_of(spark, lambda: got).count("Scan parquet") == 2
    dealt = _mentions_dealt(fx)
    assert fx.m_mentions.exceptAll(dealt).isEmpty() and dealt.exceptAll(fx.m_mentions).isEmpty()
    # Digests of a line are made after the shuffle to its document.
    plan = plan_of(spark, lambda: dealt)
    assert plan.index("sha2(") < plan.index("REPARTITION_BY_NUM") and "sha2(" not in plan[plan.index("REPARTITION_BY_NUM"):plan.index("FileScan")]


def test_digests_are_packed_and_other_ids_are_left(spark):
    hexes = "ab01" * 16
    ids = [hexes, hexes.upper(), hexes[:-1], hexes + "-b", "é" * 32, "g" * 64, "", "\x01", "gone", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ids)], "i int, t string").repartition(2)
    packed = rows.withColumn("p", packed_digest(F.col("t")))
    found = packed.select("i", "t", F.length("p").alias("n"), unpacked_digest(F.col("p")).alias("back")).collect()
    assert all(r.back == r.t for r in found) and len(found) == len(ids)
    assert {r.n for r in found if r.i == 0} == {33} and packed.select("p").distinct().count() == len(ids)


def test_documents_meet_the_evidence_where_both_lie(spark, tmp_path):
    s = stored_by_document(Fixtures(spark, write_given(spark, tmp_path)))
    top = gold.top_stance_contexts(s.mentions, s.documents, s.dates, s.contexts, s.categories, s.audit)
    assert top.count() > 0
    plan = re.sub(r"#\d+L?", "", plan_of(spark, lambda: top))
    assert not any(keys.startswith("document_id") for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan))
    # A document that is listed twice shows its passages twice, and counts them once.
    twice = gold.top_stance_contexts(
        s.mentions, s.documents.unionByName(s.documents), s.dates, s.contexts, s.categories, s.audit
    )
    rank = "absolute_stance_rank_by_figure_period"
    assert twice.agg(F.max(rank)).first() == top.agg(F.max(rank)).first()
    assert twice.count() == top.count() + top.where("metadata_parse_status IS NOT NULL").count()
