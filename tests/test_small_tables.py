"""Rows are shuffled for what they have many of, and not for the small tables that they are joined with."""

import re

from pyspark.sql import functions as F

from checks import queries
from checks.fixtures import Fixtures
from rostra.operators.joins import join_bridge_expand


def _shuffles(rows):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", re.sub(r"#\d+L?", "", plan))


def test_a_bridge_is_shuffled_once(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "document_id string, n int")
    bridge = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), (None, "z")], "document_id string, member string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = join_bridge_expand(rows, bridge, ["member"])
        assert all(keys.startswith("document_id, 4") for keys in _shuffles(found)) and len(_shuffles(found)) == 2
        got = sorted((r.document_id or "", r.n, r.member, r.member_weight) for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [("", 3, None, 1), ("a", 1, "x", 2), ("a", 1, "y", 1), ("b", 2, None, 1)]


def test_small_tables_are_stored_before_they_are_joined(spark):
    folder = "/made"
    given = {
        "m_dates": spark.range(3).select(F.col("id").cast("string").alias("date_key")).distinct(),
        "m_categories": spark.range(2).select(F.col("id").cast("string").alias("stance_category_id")).distinct(),
    }
    small = queries.small_once(Fixtures(spark, folder, given), "m_dates", "m_categories")
    for name, rows in given.items():
        assert not _shuffles(getattr(small, name))
        assert sorted(getattr(small, name).collect()) == sorted(rows.collect())
