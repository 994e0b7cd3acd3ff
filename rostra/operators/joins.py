"""Join shapes used by the plans. All are equi-joins on the keys given.

None of them forces a broadcast: Spark sends a side whole only when its own size
check allows it, at planning time or, with adaptive execution, from measured sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_star_left(fact: DataFrame, *dimensions: tuple[DataFrame, str | list[str]]) -> DataFrame:
    """Fact rows with every matching dimension attached; unmatched ones keep NULLs."""
    return reduce(lambda rows, d: rows.join(d[0], d[1], "left"), dimensions, fact)


def join_anti_resumable(todo: DataFrame, done: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows of ``todo`` whose key does not occur in ``done``."""
    names = [keys] if isinstance(keys, str) else keys
    return todo.join(done.select(*names), names, "left_anti")


def null_safe_condition(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[key].eqNullSafe(right[key]) for key in keys])


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left"
) -> DataFrame:
    """Join on nullable keys where NULL meets NULL; keys are kept from the left side."""
    joined = left.join(right, null_safe_condition(left, right, keys), how)
    return joined.drop(*[right[key] for key in keys])


def join_bridge_expand(
    rows: DataFrame,
    bridge: DataFrame,
    member_columns: list[str],
    key: str = "document_id",
    placed: bool = False,
) -> DataFrame:
    """Rows repeated per bridge member, with ``member_weight`` bridge rows folded into one.

    A member listed twice for the same document (positions differ) counts twice in
    sums but is one document, so the multiplicity travels as a weight and distinct
    counts become plain row counts.

    Bridge rows are dealt by ``key`` once, for the fold and the join: hardly any repeat, so
    folding them before would not make them fewer. Those without a key belong to no row.
    A ``placed`` bridge is stored in buckets by ``key`` and folded where it lies.
    """
    known = bridge.where(F.col(key).isNotNull())
    members = (known if placed else known.repartition(key)).groupBy(key, *member_columns).agg(
        F.count(F.lit(1)).alias("member_weight")
    )
    return rows.join(members, key, "left").withColumn(
        "member_weight", F.coalesce("member_weight", F.lit(1).cast("bigint"))
    )
